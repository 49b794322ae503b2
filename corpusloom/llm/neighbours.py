"""Nearest neighbours by a block matrix join.

1. Every vector is normalised and quantised once: int8 components, their scale and the norm of what is lost. Only these
   are shipped to the tiles, a candidate once for each block of queries.
2. A tile multiplies a block of queries with a block of candidates (products of int8 values are exact in float32 below
   2**24). The lost norms bound how far a tile's value is from the cosine, so a candidate whose upper bound is below the
   k-th best lower bound can't be among the nearest. What survives leaves the tile with its bounds.
3. The bounds of all tiles give each query a tighter floor. The survivors above it are recomputed in double precision on
   the original vectors, fetched by id, and merged by heaps of k.
4. A query whose survivors of one tile are more than `survivors` (a dense cluster, very many copies) has that block of
   candidates searched on the original vectors instead, tile by tile with heaps, so no cluster's pairs become rows.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, as queries or
candidates; vectors of any magnitude are scaled by a power of two first, which is exact; ties go to the smaller vec_id;
rows of one id are one item, whose nearness is the largest over its vectors, so an id is found once and not by itself;
vectors of different lengths are not compared; fewer than k candidates give fewer rows; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SUBTILE = 512  # candidates multiplied at once


def usable(vector: str) -> Column:
    """Whether all components are finite numbers and one isn't zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component into [0.5, 1): squares stay in range."""
    exponent = np.frexp(np.abs(x).max(axis=1))[1]
    return np.ldexp(x, -exponent[:, None])


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows as scale * int8 values: the values, scales, and norms of what is lost."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    return q.astype(np.int8), scale, np.linalg.norm(unit - q * scale[:, None], axis=1)


@dataclass
class Quantised:
    ids: np.ndarray
    q: np.ndarray
    scale: np.ndarray
    lost: np.ndarray

    @classmethod
    def of(cls, frame: pd.DataFrame) -> Quantised:
        values = np.frombuffer(b"".join(frame["bytes"]), np.int8).reshape(len(frame), -1)
        return cls(frame["vec_id"].to_numpy(), values, frame["scale"].to_numpy(), frame["lost"].to_numpy())

    def rows(self, at: slice) -> Quantised:
        return Quantised(self.ids[at], self.q[at], self.scale[at], self.lost[at])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows, summed component by component so that equal vectors give equal values everywhere."""
    dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
    for j in range(a.shape[1]):
        dot += a[:, j] * b[:, j]
        aa += a[:, j] * a[:, j]
        bb += b[:, j] * b[:, j]
    return dot / (np.sqrt(aa) * np.sqrt(bb))


class Nearest:
    """A heap of the k nearest ids, each once."""

    def __init__(self, k: int):
        self.k, self.heap, self.known = k, [], {}

    def offer(self, score: float, vec_id: int) -> None:
        if vec_id in self.known:
            if score > self.known[vec_id]:
                self.heap = [(s, i) for s, i in self.heap if i != -vec_id] + [(score, -vec_id)]
                heapq.heapify(self.heap)
                self.known[vec_id] = score
        elif len(self.heap) < self.k or (score, -vec_id) > self.heap[0]:
            heapq.heappush(self.heap, (score, -vec_id))
            self.known[vec_id] = score
            if len(self.heap) > self.k:
                del self.known[-heapq.heappop(self.heap)[1]]

    @property
    def full(self) -> bool:
        return len(self.heap) == self.k


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int8 values, exact: float32 sums stay below 2**24."""
    width = (1 << 24) // (127 * 127)
    out = np.zeros((len(a), len(b)))
    for j in range(0, a.shape[1], width):
        out += a[:, j : j + width].astype(np.float32) @ b[:, j : j + width].astype(np.float32).T
    return out


def bounded(left: Quantised, right: Quantised) -> tuple[np.ndarray, np.ndarray]:
    """Values of a tile and how far the cosines can be from them; a pair of one id is -inf."""
    value = products(left.q, right.q) * left.scale[:, None] * right.scale
    value[left.ids[:, None] == right.ids] = -np.inf
    return value, left.lost[:, None] + (1 + left.lost)[:, None] * right.lost + 1e-9


class Floor:
    """The k-th best lower bound of each query so far, over different ids."""

    def __init__(self, queries: int, ids: np.ndarray, k: int):
        self.best, self.k = np.full((queries, k), -np.inf), k
        self.distinct = len(np.unique(ids)) == len(ids)  # else one id's rows might fill the places of k ids

    def seen(self, lower: np.ndarray) -> np.ndarray:
        if self.distinct:
            both = np.concatenate([self.best, lower], axis=1)
            self.best = np.partition(both, -self.k, axis=1)[:, -self.k :]
        return self.best.min(axis=1)


def survivors_of(left: Quantised, right: Quantised, k: int, most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """([query row, candidate row, lower, upper], crowded query rows): those that a tile can't rule out.

    Of a crowded query, one with more than `most` survivors, only the k best go out, for their bounds.
    """
    floors, floor = Floor(len(left.ids), right.ids, k), np.full(len(left.ids), -np.inf)
    found: list[np.ndarray] = [np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0)]
    for a in range(0, len(right.ids), SUBTILE):
        value, bound = bounded(left, right.rows(slice(a, a + SUBTILE)))
        floor = floors.seen(value - bound)
        rows, cols = np.nonzero((value + bound >= floor[:, None]) & np.isfinite(value))
        new = rows, cols + a, (value - bound)[rows, cols], (value + bound)[rows, cols]
        found = [np.concatenate(x) for x in zip(found, new, strict=True)]
        kept = found[3] >= floor[found[0]]
        found = [x[kept] for x in found]
    rows, lower = found[0], found[2]
    crowded = np.bincount(rows, minlength=len(left.ids)) > most
    order = np.lexsort((-lower, rows))
    place = np.arange(len(order)) - np.searchsorted(rows[order], rows[order])
    out = order[(place < k) | ~crowded[rows[order]]]
    return [x[out] for x in found], np.flatnonzero(crowded)


def tile_nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[int, float, int]]:
    """(query id, score, candidate id): the k nearest ids of a tile of original vectors for each query row."""
    queries, vectors = scaled(queries), scaled(vectors)
    left, heaps = Quantised(query_ids, *quantised(queries)), [Nearest(k) for _ in query_ids]
    floors, least = Floor(len(query_ids), ids, k), np.full(len(query_ids), -np.inf)
    for a in range(0, len(ids), SUBTILE):
        cand = vectors[a : a + SUBTILE]
        part = Quantised(ids[a : a + SUBTILE], *quantised(cand))
        value, bound = bounded(left, part)
        floor = np.maximum(floors.seen(value - bound), least)
        rows, cols = np.nonzero((value + bound >= floor[:, None]) & np.isfinite(value))
        for r, s, c in zip(rows.tolist(), cosine(queries[rows], cand[cols]).tolist(), part.ids[cols].tolist(), strict=True):
            heaps[r].offer(s, c)
        least = np.array([h.heap[0][0] - 1e-9 if h.full else -np.inf for h in heaps])
    return [(int(q), s, -c) for q, h in zip(query_ids, heaps, strict=True) for s, c in h.heap]


SHIPPED = "vec_id long, dim int, q binary, scale double, lost double"


def shipped(rows: DataFrame) -> DataFrame:
    """rows (vec_id, embedding, dim) quantised, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
                q, scale, lost = quantised(scaled(x))
                columns = [part.column(0), part.column(2), pa.array([r.tobytes() for r in q], pa.binary()), pa.array(scale), pa.array(lost)]
                yield pa.record_batch(columns, ["vec_id", "dim", "q", "scale", "lost"])

    return rows.select("vec_id", "embedding", "dim").mapInArrow(run, SHIPPED)


def recomputed(pairs: DataFrame, queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, score, vec_id) of the k nearest in each task for every query, by heaps, on the original vectors."""
    full = pairs.join(candidates.select("vec_id", F.col("embedding").alias("c"), "dim"), "vec_id")
    full = full.join(queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"), "dim"), ["query_id", "dim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, Nearest] = {}

        def out() -> pa.RecordBatch:
            found = [(q, s, -c) for q, h in heaps.items() for s, c in h.heap]
            heaps.clear()
            return pa.record_batch([pa.array([r[i] for r in found], t) for i, t in enumerate((pa.int64(), pa.float64(), pa.int64()))], ["query_id", "score", "vec_id"])

        for batch in batches:
            dims = batch.column(4).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                q, c = (scaled(part.column(i).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)) for i in (2, 3))
                for a, s, b in zip(part.column(0).to_pylist(), cosine(q, c).tolist(), part.column(1).to_pylist(), strict=True):
                    heaps.setdefault(a, Nearest(k)).offer(s, b)
            if len(heaps) > 1 << 16:
                yield out()
        yield out()

    return full.select("query_id", "vec_id", "q", "c", "dim").mapInArrow(run, "query_id long, score double, vec_id long")


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 5, query_block: int = 8192, candidate_block: int = 65536, components: int = 1 << 25, survivors: int = 64) -> DataFrame:
    """(query_id, rank from 1, vec_id, score). Both tables: vec_id, embedding.

    A block has about as many rows at most, and components, a byte each. Larger blocks of candidates leave fewer
    survivors, larger blocks of queries ship candidates less often. Blocks of originals have an eighth of the components.
    """

    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("long"), "embedding").where(F.col("vec_id").isNotNull() & usable("embedding"))
        return rows.withColumn("dim", F.size("embedding"))

    queries, candidates = clean(queries), clean(candidates)
    left, right = (common.materialize(shipped(x), "quantised") for x in (queries, candidates))

    def block_count(df: DataFrame, most: int, tasks: int) -> int:
        """Blocks within the bounds; of a small table enough for some tasks, while they have 4,096 rows."""
        n, total = df.agg(F.count("*"), F.coalesce(F.sum(F.col("dim").cast("long")), F.lit(0))).first()
        return max(1, -(-n // most), -(-total // components), min(tasks, n // 4096))

    rows, columns = block_count(left, query_block, 1), block_count(right, candidate_block, candidates.sparkSession.sparkContext.defaultParallelism)

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
        return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def tile(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "c", "vec_id", "lower", "upper"]
        if not len(one) or not len(two):
            return pd.DataFrame({n: pd.Series(dtype=t) for n, t in zip(names, ("int64", "int32", "Int64", "float64", "float64"), strict=True)})
        x, y = Quantised.of(one), Quantised.of(two)
        (r, c, lower, upper), crowded = survivors_of(x, y, k, survivors)
        found = pd.DataFrame({"query_id": x.ids[r], "c": int(one["c"].iloc[0]), "vec_id": pd.array(y.ids[c], "Int64"), "lower": lower, "upper": upper})
        # a block that has to be searched on the original vectors: no candidate, and no bound that rules it out
        whole = pd.DataFrame({"query_id": x.ids[crowded], "c": int(one["c"].iloc[0]), "vec_id": pd.array([None] * len(crowded), "Int64"), "lower": -np.inf, "upper": np.inf})
        return pd.concat([found, whole])[names].astype({"c": "int32"})

    def tiled(one: DataFrame, two: DataFrame, keys: list[str], function, schema: str) -> DataFrame:
        return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInPandas(function, schema)

    bounds = tiled(dealt(left.withColumnRenamed("q", "bytes"), "q", rows, "c", columns), dealt(right.withColumnRenamed("q", "bytes"), "c", columns, "q", rows), ["dim", "q", "c"], tile, "query_id long, c int, vec_id long, lower double, upper double")
    bounds = common.materialize(bounds, "bounds")
    pairs = bounds.where("vec_id IS NOT NULL").groupBy("query_id", "vec_id").agg(F.max("lower").alias("lower"), F.max("upper").alias("upper"))
    place = F.row_number().over(common.window("query_id").orderBy(F.desc("lower"), "vec_id"))
    floors = pairs.withColumn("place", place).where(F.col("place") <= k).where(F.col("place") == k).select("query_id", F.col("lower").alias("floor"))
    kept = pairs.join(floors, "query_id", "left").where(F.col("floor").isNull() | (F.col("upper") >= F.col("floor"))).select("query_id", "vec_id")
    near = recomputed(kept, queries, candidates, k)
    crowded = common.materialize(bounds.where("vec_id IS NULL").select("query_id", "c").distinct(), "crowded")
    if crowded.limit(1).count():

        def search(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
            found: list[tuple[int, float, int]] = []
            if len(one) and len(two):
                found = tile_nearest(one["vec_id"].to_numpy(), np.stack(one["embedding"]).astype(float), two["vec_id"].to_numpy(), np.stack(two["embedding"]).astype(float), k)
            return pd.DataFrame(found, columns=["query_id", "score", "vec_id"]).astype({"query_id": "int64", "score": "float64", "vec_id": "int64"})

        parts = 8  # of a block: originals take up to eight bytes a component
        h, keys = F.xxhash64("vec_id"), ["dim", "q", "c", "part"]
        one = queries.join(crowded.withColumnRenamed("query_id", "vec_id"), "vec_id").withColumn("q", F.pmod(h, F.lit(rows)).cast("int"))
        wanted = common.materialize(one.select("dim", "q", "c").distinct(), "crowded-tiles")
        one = one.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        two = candidates.withColumns({"c": F.pmod(h, F.lit(columns)).cast("int"), "part": F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int")}).join(wanted, ["dim", "c"])
        one, two = (x.select(*(F.col(n).alias(n) for n in ("vec_id", "embedding", *keys))) for x in (one, two))
        near = near.unionByName(tiled(one, two, keys, search, "query_id long, score double, vec_id long"))
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(common.window("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return nearest(vectors.where("vec_id % 50 = 0"), vectors)


# components are scaled by a power of two first, as squares of very large or small ones are out of range
OP6_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, list_transform(e, lambda x: x * pow(2.0, -floor(log2(list_max(list_transform(e, lambda y: abs(y))))))) AS e FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, max(list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e)))) AS score
      FROM u q JOIN u c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
