"""Scans of corpus files. Schemas are given, never inferred; paths may be globs.

Gzip files can't be split, so their rows are dealt anew after the scan.
"""

from __future__ import annotations

import ast
import bz2
import io
import json
import lzma
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_split(spark: SparkSession, path: str, split: str | None = None, kind: str = "parquet") -> DataFrame:
    """A stored dataset; `split` prunes its partition folder."""
    df = spark.read.format(kind).load(path)
    return df if split is None else df.where(F.col("split") == split)


def read_jsonl(spark: SparkSession, path: str, schema: str, partitions: int | None = None) -> DataFrame:
    """JSON lines, plain, gzip or bzip2; empty lines are no rows, broken ones fail the scan."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return df.repartition(partitions) if partitions else df


def read_json_document(spark: SparkSession, path: str, schema: str, field: str) -> DataFrame:
    """Whole-file JSON documents, a row for each element of an array field."""
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline(field))


def _delimited(line_end: str | None) -> dict[str, object]:
    """Options of quoted values that may hold anything. A null is nothing between separators: it is read as a word that
    no value can be, so that a quoted empty text stays one. Without `line_end` it is what ends a file's first line."""
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "nullValue": uuid.uuid4().hex}
    return options | ({"lineSep": line_end} if line_end else {})


def read_csv(spark: SparkSession, path: str, schema: str, line_end: str | None = None) -> DataFrame:
    return spark.read.schema(schema).csv(path, **_delimited(line_end))


def read_tsv(spark: SparkSession, path: str, schema: str, line_end: str | None = None) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", **_delimited(line_end))


def read_tsv_column(spark: SparkSession, path: str, position: int, header: bool = True, line_end: str | None = None) -> DataFrame:
    """One column of TSV files, plain or gzip, by its position from 0, without a schema."""
    schema = ", ".join(f"c{i} string" for i in range(position + 1))
    rows = spark.read.csv(path, sep="\t", schema=schema, enforceSchema=True, **_delimited(line_end) | {"header": header})
    return rows.select(F.col(f"c{position}").alias("value"))


def read_latest(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The last row of every key of a store that sinks.upsert_into wrote."""
    rows = spark.read.schema(f"{schema}, batch long").parquet(path)
    kept = [c for c in rows.columns if c != "batch"]
    return rows.groupBy(key).agg(F.max_by(F.struct(*kept), "batch").alias("x")).select("x.*")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of text files."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path).groupBy("file").agg(F.count("*").alias("lines"))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of the files below a folder, without their contents."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return df.select("path", "length")


def shard_urls(spark: SparkSession, template: str, split: str, first: int, total: int) -> DataFrame:
    """(split, url) of the first shards of a dataset; the template takes the split's suffix, the number and the total."""
    suffix = "" if split == "train" else f"-{split}"
    return spark.range(first).select(F.lit(split).alias("split"), F.format_string(template, F.lit(suffix), F.col("id"), F.lit(total)).alias("url"))


def parse_literals(lines: DataFrame, schema: StructType) -> DataFrame:
    """Rows of lines that hold Python dict literals; a line that is none fails."""
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [ast.literal_eval(x) for x in batch["line"] if x.strip()]
            yield pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names)

    return lines.select("line").mapInPandas(run, schema)


def sql_tuples(lines: DataFrame, limit: int | None = None) -> DataFrame:
    """(values array) of the tuples of INSERT INTO lines; `limit` keeps the first lines of a dump in line order."""
    rows = lines.where(F.col("line").startswith("INSERT INTO"))
    if limit is not None:
        rows = rows.orderBy("line_no").limit(limit)
    tuples = F.explode(F.regexp_extract_all("line", F.lit(r"\((.*?)\)"), F.lit(1)))
    return rows.select("line_no", tuples.alias("t")).select("line_no", F.split("t", ",").alias("values"))


def unpacked(content: bytes, path: str) -> bytes:
    if path.endswith(".xz"):
        return lzma.decompress(content)
    if path.endswith(".bz2"):
        return bz2.decompress(content)
    if path.endswith((".zst", ".zstd")):
        import zstandard

        return zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content)).read()
    return content


def read_packed_jsonl(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """String fields of JSON lines in xz or zstd files, which Spark has no codec for; missing fields are null.

    A file is one row and one task's work, so it should be a shard of bounded size.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows = [json.loads(x) for x in unpacked(content, name).decode().splitlines() if x]
                yield pd.DataFrame([[r.get(c) for c in columns] for r in rows], columns=list(columns))

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, ", ".join(f"{c} string" for c in columns))


def read_conllu(spark: SparkSession, path: str) -> DataFrame:
    """(file, sentence, metadata map) of CoNLL-U files, plain or xz: the `# key = value` lines of each sentence."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                out, meta, seen = [], {}, False
                for line in [*unpacked(content, name).decode().split("\n"), ""]:
                    line = line.rstrip("\r")
                    if not line.strip():
                        if seen:
                            out.append((name, len(out), meta))
                        meta, seen = {}, False
                    else:
                        seen = True
                        if line.startswith("#") and "=" in line:
                            key, _, value = line[1:].partition("=")
                            meta[key.strip()] = value.strip()
                yield pd.DataFrame(out, columns=["file", "sentence", "metadata"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "file string, sentence long, metadata map<string,string>")


def read_tar(spark: SparkSession, path: str, suffix: str = ".jpg") -> DataFrame:
    """(archive, path, stem, bytes) of the members of tar archives with a suffix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as archive:
                    rows = [(name, m.name, archive.extractfile(m).read()) for m in archive if m.isfile() and m.name.endswith(suffix)]
                yield pd.DataFrame(rows, columns=["archive", "path", "bytes"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = files.mapInPandas(run, "archive string, path string, bytes binary")
    return rows.select("archive", "path", stem(F.col("path")).alias("stem"), "bytes")


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)


def anchors_of(html: Column, class_name: str) -> Column:
    """Hrefs of anchors of a class, in order."""
    tag = F.regexp_extract_all(html, F.lit(rf'<a\b[^>]*class="[^"]*\b{class_name}\b[^"]*"[^>]*>'), F.lit(0))
    return F.transform(tag, lambda t: F.regexp_extract(t, 'href="([^"]*)"', 1))


@dataclass(frozen=True)
class InputConfig:
    """Files of a job by split; only kinds that there is a reader for are taken."""

    train: str | None = None
    validation: str | None = None
    kinds: tuple[str, ...] = ("csv", "json", "txt")

    def __post_init__(self) -> None:
        if self.train is None and self.validation is None:
            raise ValueError("a training or a validation file is needed")
        for split, path in (("train", self.train), ("validation", self.validation)):
            if path is not None and path.rstrip("/").rsplit(".", 1)[-1] not in self.kinds:
                raise ValueError(f"the {split} file should be one of {', '.join(self.kinds)}: {path}")

    def read(self, spark: SparkSession, split: str, schema: str) -> DataFrame:
        path = {"train": self.train, "validation": self.validation}[split]
        if path is None:
            raise ValueError(f"no {split} file")
        kind = path.rstrip("/").rsplit(".", 1)[-1]
        if kind == "csv":
            return read_csv(spark, path, schema)
        return read_jsonl(spark, path, schema) if kind == "json" else read_lines(spark, path).select(F.col("line").alias("text"))


def text_column(df: DataFrame) -> str:
    """`text` where there is one, else the first column."""
    return "text" if "text" in df.columns else df.columns[0]
