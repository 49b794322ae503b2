"""Near-duplicates by SetSketch registers: band them, estimate pairs jointly by likelihood, verify on full sets.

A register is floor(1 + log_b(a) - log_b(E)) with E the least exponential value that a register's hash gives any
shingle: exponentially spaced, truncated minima. The registers of a union are the larger ones of its parts. Equal
registers are about as likely as the Jaccard similarity J, so `rows` registers make a band key that similar documents
share, with as many bands as keep the chance to miss a pair at the threshold below `miss`.

1. Documents with equal shingle sets (128-bit digest and size) form a class; only its smallest id goes on.
2. In each bucket every member is paired with the bucket's smallest id (hub): linear in the bucket.
3. Pairs pass if the maximum-likelihood J of the counts (greater, less, equal registers; sizes known) isn't further
   than `sigmas` standard errors below the threshold; then the exact J of the full sets decides.
4. Components of the links. A bucket whose members are all in one component is settled. The members of other buckets of
   three or more are compared in blocks, across components only, by estimate and then by exact counts; only links that
   join two components leave a block, so hot buckets need no cap and their pairs are never rows.

Defined cases: null or empty texts and texts without words have an empty set and are linked with nothing; fewer words
than the shingle length make one shingle, and texts of any length are taken whole; repeated rows are copies; an id that
comes with several texts is one node, linked where any of them is, and each of its rows has the size of its own set;
rows without an id take part in nothing and get null component_id and kept; ties can't arise, as ids decide; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from . import textvec as tv
from .graph import components

BASE = 1.01  # b of the sketch
RATE = 20.0  # a of the sketch
BLOCK = 2048  # members of an unsettled bucket in one block
BLOCK_SHINGLES = 1 << 21  # shingles of a block, about


@dataclass(frozen=True)
class NearDupConfig:
    shingle: int = 5
    threshold: tuple[int, int] = (80, 100)  # similarity of at least the first by the second
    rows: int = 5
    miss: float = 1e-6
    sigmas: float = 5.0

    @property
    def ratio(self) -> float:
        return self.threshold[0] / self.threshold[1]

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log1p(-(self.ratio**self.rows)))

    @property
    def registers(self) -> int:
        return self.rows * self.bands

    @property
    def least_estimate(self) -> float:
        return self.ratio - self.sigmas * math.sqrt(self.ratio * (1 - self.ratio) / self.registers)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's k-word shingles."""
    data = tv.LOWER[data]
    starts, ends, at = tv.word_spans(data, offsets, tv.NONSPACE)
    words = tv.word_hash(data, starts, ends)
    grams = tv.gram_hash(words, k)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        else:
            out.append(tv.gram_hash(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def registers(shingles: np.ndarray, m: int) -> np.ndarray:
    """m SetSketch registers of a non-empty set of hashes."""
    values = tv.rule_values(2 * m, 31)
    mult, add = (values[:m] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (values[m:] >> np.uint64(32)).astype(np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(m, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(x), 512):
        np.minimum(least, (mult[:, None] * x[a : a + 512] + add[:, None]).min(axis=1), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32)
    return np.clip(np.floor(1 + (math.log(RATE) - np.log(exponential)) / math.log(BASE)), 0, 65535).astype(np.uint16)


def likely_similarity(greater: np.ndarray, less: np.ndarray, m: int, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs from their register counts and set sizes (grid, then refined)."""
    u = n1 / (n1 + n2)
    v = 1 - u
    top = np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def value(j: np.ndarray) -> np.ndarray:
        over, under = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
        tiny = 1e-12
        return greater[:, None] * np.log(over + tiny) + less[:, None] * np.log(under + tiny) + (m - greater - less)[:, None] * np.log(np.maximum(1 - over - under, tiny))

    low, high = np.zeros(len(u)), top
    for _ in range(3):
        grid = low[:, None] + (high - low)[:, None] * np.linspace(0, 1, 17)
        best = value(grid).argmax(axis=1)
        rows = np.arange(len(u))
        low, high = grid[rows, np.maximum(best - 1, 0)], grid[rows, np.minimum(best + 1, 16)]
    return (low + high) / 2


def passes(r1: np.ndarray, r2: np.ndarray, n1: np.ndarray, n2: np.ndarray, config: NearDupConfig) -> np.ndarray:
    """Whether pairs of register rows may reach the threshold."""
    over, under = (r1 > r2).sum(axis=1), (r1 < r2).sum(axis=1)
    return likely_similarity(over, under, config.registers, n1.astype(float), n2.astype(float)) >= config.least_estimate


SKETCH = "doc_id long, n_shingles long, d1 long, d2 long, regs binary, bands array<long>"


def sketches(documents: DataFrame, config: NearDupConfig) -> DataFrame:
    """A row per document: set size, set digest, registers and band keys (null for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = config.registers
        for batch in batches:
            for a, b, data, offsets in tv.chunks(batch, "text"):
                sets = shingle_sets(data, offsets, config.shingle)
                d1 = np.array([np.bitwise_xor.reduce(s) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                d2 = np.array([tv.mix(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                regs = [registers(s, m) if len(s) else None for s in sets]
                full = np.array([r for r in regs if r is not None]).reshape(-1, config.bands, config.rows).astype(np.uint64)
                keys = np.tile(np.arange(1, config.bands + 1, dtype=np.uint64), (len(full), 1))
                for j in range(config.rows):
                    keys = tv.mix(keys * np.uint64(0x9E3779B97F4A7C15) ^ full[:, :, j])
                bands = iter(keys.view(np.int64).tolist())
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(d1),
                        pa.array(d2),
                        pa.array([None if r is None else r.tobytes() for r in regs], pa.binary()),
                        pa.array([None if r is None else next(bands) for r in regs], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "d1", "d2", "regs", "bands"],
                )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SKETCH)


def estimated(pairs: DataFrame, sketch: DataFrame, config: NearDupConfig) -> DataFrame:
    """The pairs (a, b) that the joint estimate lets pass."""
    side = sketch.select("doc_id", "n_shingles", "regs")
    full = pairs.join(side.toDF("a", "n1", "r1"), "a").join(side.toDF("b", "n2", "r2"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = config.registers
        for batch in batches:
            if batch.num_rows:
                t = {n: batch.column(n) for n in batch.schema.names}
                r1, r2 = (np.frombuffer(b"".join(t[x].to_pylist()), np.uint16).reshape(-1, m) for x in ("r1", "r2"))
                ok = passes(r1, r2, t["n1"].to_numpy(), t["n2"].to_numpy(), config)
                yield pa.record_batch([t["a"].filter(pa.array(ok)), t["b"].filter(pa.array(ok))], ["a", "b"])

    return full.select("a", "b", "n1", "n2", "r1", "r2").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, documents: DataFrame, config: NearDupConfig) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold. documents: one row per id."""
    involved = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = common.materialize(documents.select("doc_id", "text").join(involved, "doc_id", "left_semi"), "texts")
    full = pairs.join(texts.toDF("a", "t1"), "a").join(texts.toDF("b", "t2"), "b")
    num, den = config.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, np.zeros(0, np.uint64)
        for batch in batches:
            hubs, ok = batch.column("a").to_pylist(), np.zeros(batch.num_rows, bool)
            for a, b, data, offsets in tv.chunks(batch, "t2"):
                for i, s in zip(range(a, b), shingle_sets(data, offsets, config.shingle), strict=True):
                    if hubs[i] != last:
                        raw = np.frombuffer(batch.column("t1")[i].as_py().encode(), np.uint8)
                        last, kept = hubs[i], shingle_sets(raw, np.array([0, len(raw)]), config.shingle)[0]
                    both = len(np.intersect1d(kept, s, assume_unique=True))
                    ok[i] = den * both >= num * (len(kept) + len(s) - both)
            yield pa.record_batch([batch.column(x).filter(pa.array(ok)) for x in ("a", "b")], ["a", "b"])

    return full.select("a", "b", "t1", "t2").mapInArrow(run, "a long, b long")


def block_links(frame: pd.DataFrame, band: int, across: bool, config: NearDupConfig) -> list[tuple[int, int]]:
    """Links between members of a block (or across its two halves) that are in different components so far.

    A pair is looked at in the first band that it shares only. Its sketch estimate comes first; then the shared shingles
    are counted exactly, one member against all at once. Pairs that links found here join already are passed over.
    """
    frame = frame.drop_duplicates("doc_id")
    ids, size, mine = (frame[c].to_numpy() for c in ("doc_id", "n_shingles", "mine"))
    bands, regs = np.stack(frame["bands"]), np.frombuffer(b"".join(frame["regs"]), np.uint16).reshape(len(ids), -1)
    _, root = np.unique(frame["component"].to_numpy(), return_inverse=True)
    raw = pa.array(frame["text"], pa.large_string())
    sets = [s for _, _, data, at in tv.chunks(pa.record_batch([raw], ["text"]), "text") for s in shingle_sets(data, at, config.shingle)]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    kinds, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    mark, num, den, links = np.zeros(len(kinds), bool), *config.threshold, []
    for x in range(len(ids) - 1):
        y = np.flatnonzero(root[x + 1 :] != root[x]) + x + 1
        y = y[(mine[y] != mine[x]) | (not across)]
        y = y[np.minimum(size[y], size[x]) * den >= np.maximum(size[y], size[x]) * num]
        same = bands[y] == bands[x]
        y = y[(bands[x][same.argmax(axis=1)] == band) & same.any(axis=1)] if len(y) else y
        if len(y):
            y = y[passes(np.broadcast_to(regs[x], (len(y), regs.shape[1])), regs[y], np.full(len(y), size[x]), size[y], config)]
        if not len(y):
            continue
        mark[inverse[offsets[x] : offsets[x + 1]]] = True
        both = np.array([mark[inverse[offsets[i] : offsets[i + 1]]].sum() for i in y])
        mark[inverse[offsets[x] : offsets[x + 1]]] = False
        for i in y[den * both >= num * (size[x] + size[y] - both)]:
            if root[i] != root[x]:
                root[root == root[i]] = root[x]
                links.append((int(min(ids[x], ids[i])), int(max(ids[x], ids[i]))))
    return links


def unsettled_links(buckets: DataFrame, sizes: DataFrame, reps: DataFrame, texts: DataFrame, labels: DataFrame, config: NearDupConfig) -> DataFrame:
    """Links (a, b) across components inside buckets of three or more that are not in one component yet.

    Buckets are cut into blocks of a bounded number of members and shingles; a group is one pair of blocks of a bucket,
    and gives at most a link for each member.
    """
    named = (
        buckets.join(sizes.where("n > 2").select("band", "n", "shingles"), "band")
        .join(labels.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )
    spread = named.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most")
    rows = common.materialize(named.join(spread.select("band"), "band", "left_semi"), "unsettled")
    ids = rows.select("doc_id").distinct()
    full = reps.join(ids, "doc_id", "left_semi").join(texts, "doc_id").select("doc_id", "n_shingles", "regs", "bands", "text")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("doc_id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})
    rows = rows.select("band", "i", "j", "mine", "doc_id", "component").join(common.materialize(full, "unsettled-texts"), "doc_id")

    def compare(key, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(block_links(frame, key[0], key[1] != key[2], config), columns=["a", "b"], dtype="int64")

    return rows.groupBy("band", "i", "j").applyInPandas(compare, "a long, b long")


def near_duplicates(documents: DataFrame, config: NearDupConfig | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links), kept (doc_id = component_id)."""
    config = config or NearDupConfig()
    documents, ids = common.with_uid(documents.select(F.col("doc_id").cast("long"), "text"))
    documents = documents.select(F.col("uid").alias("doc_id"), "text")  # from here on, ids are uids
    sketch = common.materialize(sketches(documents, config), "sketches")
    own = F.col("doc_id")
    classes = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    members = common.salted_join(sketch.select("doc_id", "d1", "d2", "n_shingles"), classes.where("n > 1").drop("n"), ["d1", "d2", "n_shingles"], "doc_id")
    members = common.materialize(members.select("doc_id", "n_shingles", F.when(own.isNotNull(), F.coalesce("rep", own)).alias("rep")), "members")
    reps = sketch.join(members.where("doc_id = rep").select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    reps = common.materialize(reps.where("n_shingles > 0"), "representatives")
    buckets = reps.select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).where("n > 1")
    sizes = common.materialize(sizes, "buckets")
    stars = buckets.join(sizes, "band").where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    texts = documents.join(reps.select("doc_id"), "doc_id", "left_semi")
    texts = texts if ids is None else texts.dropDuplicates(["doc_id"])  # rows of one uid have one text
    links = verified(estimated(stars, reps, config), texts, config)
    links = common.materialize(links if ids is None else links.union(same_id(members, ids)), "star-links")
    labels = components(links)
    more = common.materialize(unsettled_links(buckets.select("doc_id", "band"), sizes, reps, texts, labels, config), "more-links")
    if more.limit(1).count():
        labels = components(links.union(more))
    found = members.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    if ids is not None:
        found = found.join(ids.toDF("doc_id", "id"), "doc_id", "left").join(ids.toDF("component_id", "least"), "component_id", "left")
        found = found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", (own == F.col("component_id")).alias("kept"))


def same_id(members: DataFrame, ids: DataFrame) -> DataFrame:
    """Links (a, b) between the classes that one id's texts are in."""
    full = members.where("n_shingles > 0").join(ids.toDF("doc_id", "id"), "doc_id").select("id", "rep").distinct()
    return full.join(full.groupBy("id").agg(F.min("rep").alias("a")), "id").where("a <> rep").select("a", F.col("rep").alias("b"))


def drop_near_duplicates(documents: DataFrame, config: NearDupConfig | None = None) -> DataFrame:
    """documents with one row of each group (the smallest id); rows without an id stay.

    Of an id's repeats the one whose text has the smallest SHA-256 stays; of rows with equal id and text, any one.
    """
    groups = near_duplicates(documents, config)
    gone = groups.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    kept = documents.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    ids = documents.where("doc_id IS NOT NULL").groupBy("doc_id").count()
    if ids.where("count > 1").limit(1).count():
        marked = kept.where("doc_id IS NOT NULL").withColumn("__digest", F.sha2(F.coalesce("text", F.lit("")), 256))
        first = marked.groupBy("doc_id").agg(F.min("__digest").alias("__first"))
        one = marked.dropDuplicates(["doc_id", "__digest"]).join(first.withColumnRenamed("doc_id", "__id"), F.col("doc_id") == F.col("__id"))
        kept = one.where("__digest = __first").select(*documents.columns).unionByName(kept.where("doc_id IS NULL"))
    return kept


def op3_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), NearDupConfig(shingle=3, threshold=(85, 100)))


OP3_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, c) AS (SELECT a, a FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.id = doc_id
"""
