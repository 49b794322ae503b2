"""Tables in the shared folder, and positions that don't need one task."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str, split_bytes: int = 128 << 20) -> DataFrame:
    """df dealt over all cores by key, where it has fewer files than cores, of less than a split's bytes for each core.

    A file with one row group is one task however large the cluster. What is moved is bounded by the cores; larger
    inputs have splits enough and are left as they are, without a shuffle (nor are their files listed).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df if cores == 1 or size >= cores * split_bytes or len(df.inputFiles()) >= cores else df.repartition(4 * cores, key)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def application_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables are."""
    return f"{shared_root(spark)}/corpusloom/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; results that read them must have been written by then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a folder of the warehouse in local mode; a cluster has to name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.shared"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write and read again: cuts lineage and fixes what a plan must not compute twice differently."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int, *keys: str, each: int = 200_000) -> DataFrame:
    """df dealt by keys in parts of about `each` of its `rows` rows. Adaptive execution leaves a number that is given as it
    is; its own parts are of compressed bytes, so that rows of a few bytes become millions for a task to sort."""
    return df.repartition(max(1, -(-rows // each)), *keys)


SALTS = 16


def salted_join(rows: DataFrame, table: DataFrame, keys: list[str], spread_by: str) -> DataFrame:
    """rows left join table (a row per key), where one key may have very many rows: its rows are dealt to SALTS tasks.

    table is repeated as often, so it should hold only the keys that matter.
    """
    left = rows.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    right = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [*keys, "__salt"], "left").drop("__salt")


def ranged(df: DataFrame, *order: str | Column) -> DataFrame:
    """df stored in range partitions of `order`, with __part and the place in it, __at; as many as shuffles have, more for large inputs."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = min(max(least, size // (128 << 20)), 100 * least)  # a size estimated through joins may be far too large
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stored(rows.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "ranged")


def _carried(rows: DataFrame, total: Column) -> DataFrame:
    """(__part, __before): the total of all partitions before each; one row per partition, a bound that doesn't grow with rows."""
    sums = rows.groupBy("__part").agg(total.alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sums.select("__part", before.alias("__before"))


def with_row_index(df: DataFrame, *order: str | Column, name: str = "row_index") -> DataFrame:
    """df with its 0-based position in `order`, a total order.

    Rows are range-partitioned and sorted; a row's index is its place in its partition plus the rows of the partitions
    before. Only the counts of the partitions meet in one task.
    """
    rows = ranged(df, *order)
    counts = _carried(rows, F.count("*"))
    return rows.join(F.broadcast(counts), "__part").withColumn(name, F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")


def with_running_sum(df: DataFrame, value: str, *order: str | Column, name: str) -> DataFrame:
    """df with the sum of `value` over all rows before in `order`, a total order; partitions as for with_row_index."""
    rows = ranged(df, *order)
    inside = F.sum(value).over(Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1))
    full = rows.withColumn(name, F.coalesce(inside, F.lit(0))).join(F.broadcast(_carried(rows, F.sum(value))), "__part")
    return full.withColumn(name, F.col(name) + F.col("__before")).drop("__part", "__at", "__before")
