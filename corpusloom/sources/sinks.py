"""Writers of corpus files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tables import stored, with_row_index

PART = 16 << 20


# Blanks at the ends of a value stay, and a null is nothing where an empty text is a pair of quotes.
QUOTED = {"header": True, "quote": '"', "escape": '"', "lineSep": "\n", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, **QUOTED)


def write_tsv(df: DataFrame, path: str, mode: str = "append", compression: str | None = None) -> None:
    """Tab-separated with a header, values that need it in quotes; batches append."""
    df.write.mode(mode).csv(path, sep="\t", compression=compression or "none", **QUOTED)


def write_jsonl(df: DataFrame, path: str, compression: str | None = None, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path, compression=compression or "none", ignoreNullFields=False)


def write_shards(df: DataFrame, path: str, order: str, rows: int) -> None:
    """Contiguous shards of `rows` rows as gzip JSON lines, a folder for each with its 1-based 12-digit number."""
    shard = F.lpad((F.floor(F.col("row_index") / rows) + 1).cast("string"), 12, "0")
    parts = with_row_index(df, order).withColumn("shard", shard).drop("row_index")
    parts.repartition("shard").sortWithinPartitions("shard", order).write.partitionBy("shard").json(path, compression="gzip", ignoreNullFields=False)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_nested(df: DataFrame, path: str) -> None:
    """Nested rows as JSON, with their nulls."""
    df.write.json(path, ignoreNullFields=False)


def write_text(df: DataFrame, path: str, line: str, *order: str) -> None:
    """Text files in order: the part files one after another are the whole. A file has about PART bytes."""
    rows = stored(df.select(*dict.fromkeys([*order, line])), "lines")
    size = rows.agg(F.sum(F.octet_length(line))).first()[0] or 0
    parts = rows.repartitionByRange(max(1, -(-size // PART)), *order).sortWithinPartitions(*order)
    parts.select(line).write.text(path)


def escaped_csv_line(*columns: str):
    """A CSV line whose quotes are escaped by a backslash."""
    return F.concat_ws(",", *(F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('\\"')), F.lit('"')) for c in columns))


def write_json_documents(df: DataFrame, path: str, field: str, rows: int = 5000) -> None:
    """Whole-file JSON documents, indented, each an object with an array `field` of about `rows` rows of df."""
    n = max(1, -(-df.count() // rows))
    columns = F.struct(*df.columns)
    dealt = df.select(F.pmod(F.xxhash64(columns), F.lit(n)).cast("int").alias("document"), columns.alias("row"))
    documents = dealt.groupBy("document").agg(F.to_json(F.struct(F.collect_list("row").alias(field)), {"pretty": "true", "ignoreNullFields": "false"}).alias("value"))
    documents.repartition(n, "document").write.partitionBy("document").text(path)


def upsert_into(path: str) -> Callable[[DataFrame, int], None]:
    """A batch function for a keyed store of files: each batch is a folder of its own, which a repeated batch replaces.

    readers.read_latest gives every key's last row; no batch rewrites what others wrote.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return upsert


def write_metrics(df: DataFrame, path: str) -> None:
    """A one-row JSON file."""
    df.coalesce(1).write.json(path)
