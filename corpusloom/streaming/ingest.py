"""Incremental ingestion: new files since the last run, each a micro-batch; the checkpoint is the memory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def incoming(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1, clean_source: str = "off", archive: str | None = None) -> DataFrame:
    """Files of a folder as a stream; `clean_source` archives or deletes those whose batch is done."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("cleanSource", clean_source)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.parquet(path)


def process_new(stream: DataFrame, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, first: int = 9) -> None:
    """Run `step` on what is new and write each batch to a folder numbered from `first`.

    The number comes from the batch id, so a batch that is run again after a failure replaces its own output.
    """

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/part={first + number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def first_seen(stream: DataFrame, key: Column) -> DataFrame:
    """Rows whose key no earlier row had. State grows with the keys; with a watermark, bound it by
    dropDuplicatesWithinWatermark."""
    return stream.withColumn("hash", key).dropDuplicates(["hash"])


def first_seen_within(stream: DataFrame, key: Column, time: str, delay: str) -> DataFrame:
    return stream.withWatermark(time, delay).withColumn("hash", key).dropDuplicatesWithinWatermark(["hash"])


def append_to(stream: DataFrame, out: str, checkpoint: str) -> None:
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()


def upsert_each(stream: DataFrame, upsert: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Any keyed store as the sink; the function must be safe to repeat for a batch id."""
    stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def arrivals(df: DataFrame, parts: int, key: str, path: str, files: int | None = 1) -> None:
    """Write df in `parts` batches, as if they had come one after another (for tests and demonstrations).

    Each is one file, which one task writes; with files=None each has a file for every partition of df that it has rows of.
    """
    part = F.coalesce(F.pmod(F.col(key), F.lit(parts)), F.lit(0))
    for i in range(parts):
        rows = df.where(part == i)
        (rows if files is None else rows.coalesce(files)).write.mode("append").parquet(path)
