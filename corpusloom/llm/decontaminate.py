"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A test item is a set of five-word shingles; one of fewer words has its whole word sequence as its one shingle and is
sought among the documents' shingles of that many words. Items are partitioned by size (powers of two of the set size).
A partition has its own number of bottom-k minima, all shingles of a small item and a sample of a large one's, and its
own number of them that a candidate must hold: where all are sought, the containment itself, else the largest number
that an item contained to just that share misses with a chance of `miss` at most. For the candidates the contained share of the
item's full shingle set is counted exactly. Document length plays no part in the signature, so a short item is found in
a document of any length. DataFrame functions only.

Words are runs of letters and digits of the lower-cased text. Defined cases: null or empty texts have no shingles; items
without words are found nowhere; very long texts are taken whole; rows that repeat an id count as one document or item
that holds the shingles of all of them; a document at exactly the containment is found; rows without an id are left out;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LARGEST = 40  # the last partition: sets of 2**40 shingles and more


@dataclass(frozen=True)
class ContainmentConfig:
    shingle: int = 5
    containment: float = 0.8
    minima: int = 32  # of the small partitions; doubled with every fourth power of two of the size from 2**8 on
    miss: float = 1e-6

    def sought(self, partition: int) -> int:
        return self.minima << max(0, partition // 4 - 1)

    def least_held(self, partition: int) -> int:
        """The largest t for which fewer than t hits among the minima have a chance of `miss` at most.

        Minima are drawn without replacement, so the binomial tail is an upper bound.
        """
        k, p, tail, t = self.sought(partition), self.containment, 0.0, 0
        while t < k:
            tail += math.exp(math.lgamma(k + 1) - math.lgamma(t + 1) - math.lgamma(k - t + 1) + t * math.log(p) + (k - t) * math.log1p(-p))
            if tail > self.miss:
                break
            t += 1
        return max(1, t)


def words(texts: DataFrame, key: str) -> DataFrame:
    return texts.select(key, F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "").alias("w"))


def shingles(texts: DataFrame, key: str, n: int) -> DataFrame:
    """(key, shingle): a row for every run of n words of every text, repeats included."""
    rows = words(texts, key).where(F.size("w") >= n)
    lanes = F.arrays_zip(*(F.slice("w", j + 1, F.size("w") - (n - 1)).alias(f"w{j}") for j in range(n)))
    rows = rows.select(key, F.inline(lanes).alias(*(f"w{j}" for j in range(n))))
    return rows.select(key, F.xxhash64(*(f"w{j}" for j in range(n))).alias("shingle"))


def item_shingles(benchmark: DataFrame, config: ContainmentConfig) -> DataFrame:
    """(item_id, width, shingle): the distinct shingles of every item and the number of their words."""
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text")
    full = shingles(items, "item_id", config.shingle).distinct().withColumn("width", F.lit(config.shingle))
    width = F.size("w")
    whole = words(items, "item_id").where((width > 0) & (width < config.shingle))
    hashes = reduce(lambda out, n: F.when(width == n, F.xxhash64(*(F.get("w", F.lit(j)) for j in range(n)))).otherwise(out), range(1, config.shingle), F.lit(0).cast("long"))
    whole = whole.select("item_id", hashes.alias("shingle"), width.alias("width")).distinct()
    return full.unionByName(whole)


def by_partition(partition: Column, value) -> Column:
    """value(partition) as a column: a list of all partitions' values."""
    return F.element_at(F.array(*(F.lit(value(p)) for p in range(LARGEST + 1))), F.least(partition, F.lit(LARGEST)) + 1)


def contaminated(documents: DataFrame, benchmark: DataFrame, config: ContainmentConfig | None = None) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment) of the pairs at or above the containment."""
    config = config or ContainmentConfig()
    items = common.materialize(item_shingles(benchmark, config), "item-sets")
    sizes = items.groupBy("item_id").agg(F.count("*").alias("n_item_shingles"))
    items = common.materialize(items.join(sizes, "item_id"), "item-shingles")
    n, partition = F.col("n_item_shingles"), F.floor(F.log2("n_item_shingles")).cast("int")
    k = F.least(n, by_partition(partition, config.sought))
    least = F.when(k == n, F.ceil(n * config.containment - 1e-9)).otherwise(by_partition(partition, config.least_held))
    order = F.row_number().over(common.window("item_id").orderBy(F.xxhash64("shingle", F.lit(7)), "shingle"))
    minima = items.withColumns({"size_partition": partition, "k": k, "least": least, "place": order}).where("place <= k")
    # Spark broadcasts this table only while its measured size is below spark.sql.autoBroadcastJoinThreshold
    minima = common.materialize(minima.select("item_id", "width", "shingle", "size_partition", "least"), "item-minima")
    docs = documents.where("doc_id IS NOT NULL").select("doc_id", "text")
    widths = sorted(r[0] for r in minima.select("width").distinct().collect()) or [config.shingle]  # at most the shingle's length of them

    def held(texts: DataFrame, sought: DataFrame, also: list[str]) -> DataFrame:
        """(doc_id, item_id, *also, held): how many of an item's shingles in `sought` a document holds."""
        parts = [shingles(texts, "doc_id", w).join(sought.where(F.col("width") == w).drop("width"), "shingle") for w in widths]
        return reduce(DataFrame.unionByName, parts).groupBy("doc_id", "item_id", *also).agg(F.countDistinct("shingle").alias("held"))

    hits = held(docs, minima.drop("size_partition"), ["least"])
    candidates = common.materialize(hits.where("held >= least").select("doc_id", "item_id"), "containment-candidates")
    suspects = docs.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = held(suspects, items, ["n_item_shingles"]).withColumnRenamed("held", "n_shared")
    share = (F.col("n_shared") / F.col("n_item_shingles")).alias("containment")
    return counts.select("doc_id", "item_id", "n_item_shingles", "n_shared", share).where(F.col("containment") >= config.containment)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH dw AS (SELECT doc_id AS k, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents WHERE doc_id IS NOT NULL),
iw AS (SELECT item_id AS k, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
sh AS (SELECT DISTINCT k, 5 AS l, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM iw WHERE len(w) >= 5
  UNION SELECT k, len(w), array_to_string(w, ' ') FROM iw WHERE len(w) BETWEEN 1 AND 4),
ds AS (SELECT DISTINCT k, l, unnest(list_transform(range(1, len(w) - l + 2), lambda i: array_to_string(w[i:i+l-1], ' '))) AS s FROM dw, (SELECT DISTINCT l FROM sh) WHERE len(w) >= l),
n AS (SELECT k, count(*) AS n FROM sh GROUP BY k),
c AS (SELECT ds.k AS doc_id, sh.k AS item_id, count(*) AS n_shared FROM ds JOIN sh USING (s, l) GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_item_shingles, n_shared, n_shared / n AS containment
FROM c JOIN n ON n.k = c.item_id WHERE n_shared / n >= 0.8
"""
