"""What the operators share: table paths, shared-folder tables and bounded training samples."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.tables import salted_join, shared_root, stored, with_row_index  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


materialize = stored  # a Parquet table in the shared folder: cuts lineage, survives lost executors


def with_uid(documents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """documents (doc_id, text) with uid, one for each pair of id and text, in the order of ids; and (uid, doc_id).

    Where no id comes twice, uid is doc_id and there is no second table. Rows without an id have no uid. Texts of one
    id are in the order of their SHA-256.
    """
    known = documents.where("doc_id IS NOT NULL")
    if not known.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return documents.withColumn("uid", F.col("doc_id")), None
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("__digest")
    ids = with_row_index(known.select("doc_id", digest).distinct(), "doc_id", "__digest", name="uid")
    full = documents.select("*", digest).join(ids, ["doc_id", "__digest"], "left").drop("__digest")
    return full, ids.select("uid", "doc_id")


def remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo: the fold of a row."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


LARGEST = 4 << 20  # bytes of a text that a training sample may hold


def drawn(rows: DataFrame, max_rows: int) -> DataFrame:
    """At most max_rows ids of rows (doc_id, ...): those of smallest hash, a uniform draw that is the same on each run."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def sampled(documents: DataFrame, ids: DataFrame, max_bytes: int, *columns: str) -> DataFrame:
    """(doc_id, text, *columns) of the first drawn ids whose texts come to max_bytes together, in the order of the draw.

    The two bounds (ids drawn, bytes) are what the training task holds, whatever the corpus. Long texts take part like
    any other; only one of more than LARGEST bytes is passed over. Sizes are added up before any text is moved. Of an
    id's several texts the smallest is taken.
    """
    size = F.octet_length("text").cast("long")
    sizes = documents.select("doc_id", size.alias("size")).where(F.col("size") <= LARGEST).join(F.broadcast(ids.select("doc_id")), "doc_id")
    sizes = sizes.groupBy("doc_id").agg(F.max("size").alias("size"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    total = F.sum("size").over(Window.orderBy(*order))  # over the drawn ids, a bounded number
    chosen = sizes.withColumn("total", total).where(F.col("total") <= max_bytes).select("doc_id")
    one = F.min(F.struct("text", *columns)).alias("x")
    rows = documents.select("doc_id", "text", *columns).where(size <= LARGEST).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(one)
    return rows.select("doc_id", "x.*").orderBy(*order).limit(1 << 30)


def training_rows(documents: DataFrame, labels: DataFrame, label: str, max_rows: int, max_bytes: int) -> DataFrame:
    """(text, label) of a bounded sample of labelled texts, see sampled(); of an id's several labels the largest."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    ids = drawn(known, max_rows)
    rows = sampled(documents, ids, max_bytes).join(F.broadcast(ids), "doc_id")
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").select("text", "label").limit(max_rows)


def trained(rows: DataFrame, build: Callable[[pa.Table], Any]) -> Any:
    """build(rows) of a bounded sample, run in one task of an executor; only the model comes to the driver."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        table = pa.Table.from_batches(got) if got else pa.table({n: [] for n in names})
        yield pa.record_batch([pa.array([pickle.dumps(build(table))], pa.binary())], ["model"])

    models = rows.coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(models[0][0]) if models else build(pa.table({n: [] for n in names}))


def column(table: pa.Table, name: str, kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays([c.cast(kind) for c in table.column(name).chunks] or [pa.array([], kind)])


def window(*keys: str):
    return Window.partitionBy(*keys)
