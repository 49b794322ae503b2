"""Exact removal of repeated byte strings by a run-length index of the repetitive part of a corpus.

A byte goes if a `length`-byte string that covers it also starts earlier (smaller id, or earlier in the same text).

A transform over a whole corpus can't be built in bounded memory. As in prefix-free parsing, the corpus is cut into
overlapping phrases at places that the bytes alone decide, equal phrases are one entry of a dictionary, and only the
dictionary's repetitive part is transformed; a later occurrence of an entry matches in full.

1. Later exact copies of a whole text are settled by their SHA-256.
2. Every `length`-byte window has an anchor: the `gram`-byte gram of least hash in it, leftmost if equal. Equal windows
   have equal anchors, so only windows whose anchor gram occurs twice can repeat. An anchor's windows are one stretch of
   starts; the bytes of that stretch are the anchor's context.
3. Contexts are the phrases. Occurrences with equal contexts (two independent hashes of 64 and 61 bits, one modulo a
   prime) form a class, an entry of the dictionary; all but the earliest one are covered whole. What remains is the
   repetitive, varied part: the earliest context of each class of the grams that have several.
4. These contexts are dealt by gram into bounded blocks. A block is indexed: suffix array, Burrows-Wheeler transform,
   its runs, and match lengths sampled at run starts (inside a run they follow from the suffix before). The sampled
   lengths are streamed in text order as matching statistics; suffixes that share `length` bytes form intervals, and
   all but an interval's earliest window are marked. Bytes are compared here, not hashes.
5. A gram with more classes than a block holds (a passage that very many texts go on from differently) is split by the
   bytes around it: windows that hold it early have bytes after it in common, windows that hold it late bytes before it.
   Each half of the windows is dealt by gram and those bytes, contexts cut to the half that are equal byte for byte
   collapse to the earliest, and halves that are still too large are split again, down to single windows. So every
   block is bounded, every context goes through the index, and none is dropped.

Defined cases: null texts are empty; texts shorter than `length` lose nothing; texts of any length are taken whole, long
ones in overlapping segments; rows that repeat an id and its text are one text and get its result each; several texts of
one id are texts of their own, in the order of their SHA-256; rows without an id lose nothing and cause no removal; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from . import textvec as tv

SEPARATOR = 0xFF  # in no UTF-8 text
_POSITION_BITS = np.uint64(24)
_SEGMENT = 4 << 20  # bytes of one text that are anchored at once


@dataclass(frozen=True)
class RunIndexConfig:
    length: int = 100
    gram: int = 24
    block: int = 4096  # contexts indexed together, about


def text_anchors(data: np.ndarray, offsets: np.ndarray, config: RunIndexConfig) -> tuple[np.ndarray, ...]:
    """(text, key, context, check, gram start, first window start, last window start); starts count from the text's.

    context and check are two hashes of the context's bytes, the first also of the places in it.
    """
    size, w = config.length, config.length - config.gram + 1
    if len(data) < size:
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    # grams are ordered by a hash of their first eight bytes, then by place
    least = tv.words_at(data)[: len(data) - config.gram + 1] * np.uint64(0x9E3779B97F4A7C15)
    least = (least >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(least), dtype=np.uint64)
    span = 1
    while 2 * span <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: len(least) - (w - span)], least[w - span :])
    anchor = (least & ((np.uint64(1) << _POSITION_BITS) - np.uint64(1))).astype(np.int64)
    inside, fresh = np.zeros(len(anchor) + 1, bool), np.ones(len(anchor) + 1, bool)
    fresh[1:-1] = anchor[1:] != anchor[:-1]
    for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if y - x >= size:
            inside[x : y - size + 1] = True
            fresh[x] = fresh[y - size + 1] = True
    edge = np.flatnonzero(fresh)
    whole = inside[edge[:-1]]
    lo, hi = edge[:-1][whole], edge[1:][whole] - 1
    if not len(lo):
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    at = anchor[lo]
    own = np.searchsorted(offsets, lo, "right") - 1
    sums = tv.prefix_sums(data)
    key = tv.span_hash(sums, at, at + config.gram)
    context = tv.mix(tv.span_hash(sums, lo, hi + size) + ((at - lo) * 256 + (hi - lo)).astype(np.uint64))
    check = tv.prime_span_hash(tv.prime_sums(data), lo, hi + size)
    base = offsets[own]
    return own, key.view(np.int64), context.view(np.int64), check.view(np.int64), at - base, lo - base, hi - base


def anchors(documents: DataFrame, config: RunIndexConfig, keys_only: bool = False) -> DataFrame:
    def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        if len(offsets) > 2 or len(data) <= _SEGMENT:
            yield text_anchors(data, offsets, config)
            return
        for a in range(0, len(data), _SEGMENT):  # windows that start in a segment
            part = data[a : a + _SEGMENT + config.length - 1]
            own, key, context, check, at, lo, hi = text_anchors(part, np.array([0, len(part)]), config)
            yield own, key, context, check, at + a, lo + a, hi + a

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, _, data, offsets in tv.chunks(batch, "text", 1 << 18):
                for own, key, context, check, at, lo, hi in pieces(data, offsets):
                    if keys_only:
                        found, count = np.unique(key, return_counts=True)
                        yield pa.record_batch([pa.array(found), pa.array(count > 1)], ["key", "twice"])
                    else:
                        place = at << 16 | (at - lo) << 8 | (hi - lo)
                        yield pa.record_batch([pa.array(key), pa.array(context), pa.array(check), pa.array(ids[a + own]), pa.array(place)], ["key", "context", "check", "doc_id", "place"])

    return documents.mapInArrow(run, "key long, twice boolean" if keys_only else "key long, context long, check long, doc_id long, place long")


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of the bytes in order, by prefix doubling from seven bytes on."""
    n = len(text)
    # seven bytes and how many of them are there: the end sorts below any byte
    value = tv.words_at(np.concatenate([text, np.zeros(7, np.uint8)])).byteswap() & ~np.uint64(255)
    value |= np.minimum(n - np.arange(n), 7).astype(np.uint64)
    order = np.argsort(value)
    rank = np.empty(n, np.int64)
    ordered = value[order]
    rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])[:n])
    step = 7
    while n and rank.max() < n - 1:
        pair = rank * (n + 1)
        if step < n:
            pair[:-step] += rank[step:] + 1
        order = np.argsort(pair)
        ordered = pair[order]
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        step *= 2
    return order


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Common prefix lengths of suffixes a and b, up to `most`, eight bytes at a time."""
    n = len(text)
    words = tv.words_at(np.concatenate([text, np.zeros(most + 16, np.uint8)]))
    room = np.minimum(most, n - np.maximum(a, b))
    out, live = np.zeros(len(a), np.int64), np.arange(len(a))
    while len(live):
        differ = words[a[live] + out[live]] ^ words[b[live] + out[live]]
        lowest = differ & (~differ + np.uint64(1))
        out[live] += np.where(differ == 0, 8, np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64) >> 3)
        live = live[(differ == 0) & (out[live] < room[live])]
    return np.minimum(out, room)


def repeated_windows(contexts: list[bytes], doc: np.ndarray, lo: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first start, last start) of stretches of windows that an earlier (doc, start) of the block has too."""
    lengths = np.array([len(c) + 1 for c in contexts])
    text = np.frombuffer(b"".join(c + bytes([SEPARATOR]) for c in contexts), np.uint8)
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    own = np.repeat(np.arange(len(contexts)), lengths)
    inside = np.arange(len(text)) - begin[own]
    order = suffix_array(text)
    bwt = text[order - 1]
    head = np.concatenate([[True], bwt[1:] != bwt[:-1]])  # run starts of the transform
    head |= inside[order] == 0  # and context starts, so that no length is carried further than a context
    head[0] = True
    sampled, before = order[head], np.concatenate([[0], order[:-1]])[head]
    lengths_at = common_prefix(text, sampled, before, 2 * int(lengths.max()) + length)
    lengths_at[sampled == order[0]] = 0
    # matching statistics in text order: a sampled length less the way from its sample
    reach = np.zeros(len(text), np.int64)
    reach[sampled] = sampled + lengths_at
    match = np.maximum.accumulate(reach) - np.arange(len(text))
    group = np.cumsum(match[order] < length)
    when = (np.unique(doc, return_inverse=True)[1][own] << 40) + lo[own] + inside  # order of (doc, start)
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    earliest = np.minimum.reduceat(when[order], edge)
    covered = np.zeros(len(text), bool)
    covered[order] = when[order] > np.repeat(earliest, np.diff(np.append(edge, len(text))))
    covered &= inside + length < lengths[own]
    first = np.flatnonzero(covered & ~np.concatenate([[False], covered[:-1]]))
    last = np.flatnonzero(covered & ~np.concatenate([covered[1:], [False]]))
    return own[first], lo[own[first]] + inside[first], lo[own[first]] + inside[last]


CONTEXT = "group long, doc_id long, lo long, bytes binary, before int, first int, last int"


def contexts_of(documents: DataFrame, wanted: DataFrame, config: RunIndexConfig) -> DataFrame:
    """(*CONTEXT, hot): the bytes of wanted (key, doc_id, place, hot); windows hold their gram at first..last."""
    size = config.length
    wanted = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("key", "place", "hot")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, places in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raw = text.encode()
                for x in places:
                    at, left, wide = x["place"] >> 16, x["place"] >> 8 & 255, x["place"] & 255
                    rows.append((x["key"], doc, at - left, raw[at - left : at - left + wide + size], left, 0, size - config.gram, x["hot"]))
            yield _batch(rows, hot=True)

    return documents.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(cut, f"{CONTEXT}, hot boolean")


def _batch(rows: list[tuple], hot: bool = False) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()] + [pa.bool_()] * hot
    names = [c.split()[0] for c in CONTEXT.split(", ")] + ["hot"] * hot
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def halved(hot: DataFrame, config: RunIndexConfig) -> DataFrame:
    """CONTEXT rows of both halves of hot contexts' windows, each in the group of the bytes that all its windows share."""
    size = config.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for _, doc, lo, raw, before, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                least = before - (len(raw) - size)
                middle = (first + last) // 2
                for a, b in ((first, middle), (middle + 1, last)):
                    x, y = max(a, least), min(b, before)
                    if x <= y:
                        shared = raw[before - a : before + size - b] + bytes((a, b))
                        group = int.from_bytes(hashlib.blake2b(shared, digest_size=8).digest(), "little", signed=True)
                        rows.append((group, doc, lo + before - y, raw[before - y : before - x + size], y, a, b))
            yield _batch(rows)

    return hot.select(*(c.split()[0] for c in CONTEXT.split(", "))).mapInArrow(run, CONTEXT)


def repeats(documents: DataFrame, config: RunIndexConfig) -> DataFrame:
    """(doc_id, start, end, step): byte ranges to remove, overlaps allowed. documents: one row per id, no equal texts."""
    size = config.length
    keys = anchors(documents, config, keys_only=True).groupBy("key").agg(F.count("*").alias("n"), F.bool_or("twice").alias("twice"))
    keys = common.materialize(keys.where("n > 1 OR twice").select("key"), "repeated-keys")
    found = common.materialize(anchors(documents, config).join(keys, "key"), "occurrences")
    classes = found.groupBy("key", "context", "check").agg(F.min(F.struct("doc_id", "place")).alias("first"))
    classes = common.materialize(classes.select("key", "first.doc_id", "first.place"), "classes")
    # what isn't the earliest of its class: no join by class, so a class of very many occurrences is no hot key
    at, left, wide = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255), F.col("place").bitwiseAND(255)
    later = found.join(classes.select("doc_id", "place"), ["doc_id", "place"], "left_anti")
    marks = [later.select("doc_id", (at - left).alias("start"), (at - left + wide + size).alias("end"), F.lit("class").alias("step"))]
    counted = classes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    earliest = classes.join(counted, "key").select("key", "doc_id", "place", (F.col("n") > config.block).alias("hot"))
    rows = common.materialize(contexts_of(documents, earliest, config), "contexts")
    cold = rows.where("NOT hot")
    while rows.where("hot").limit(1).count():  # each round halves the windows of what is hot
        part = common.materialize(halved(rows.where("hot"), config), "halves")
        firsts = part.groupBy("group", "bytes", "before", "first", "last").agg(F.min(F.struct("doc_id", "lo")).alias("least"))
        firsts = common.materialize(firsts.select("group", "least.doc_id", "least.lo", "bytes", "before", "first", "last"), "half-classes")
        later = part.join(firsts.select("doc_id", "lo"), ["doc_id", "lo"], "left_anti")
        marks.append(later.select("doc_id", F.col("lo").alias("start"), (F.col("lo") + F.length("bytes")).alias("end"), F.lit("half").alias("step")))
        counted = firsts.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
        rows = firsts.join(counted, "group").withColumn("hot", (F.col("n") > config.block) & (F.col("first") < F.col("last"))).drop("n")
        rows = common.materialize(rows, "halved")
        cold = cold.unionByName(rows.where("NOT hot"))
    blocks = max(1, -(-cold.count() // config.block))
    cold = cold.select(F.pmod(F.xxhash64("group"), F.lit(blocks)).alias("block"), "doc_id", "lo", "bytes")

    def index(frame: pd.DataFrame) -> pd.DataFrame:
        doc, lo = frame["doc_id"].to_numpy(), frame["lo"].to_numpy()
        own, first, last = repeated_windows(frame["bytes"].tolist(), doc, lo, size)
        return pd.DataFrame({"doc_id": doc[own], "start": first, "end": last + size})

    marks.append(cold.groupBy("block").applyInPandas(index, "doc_id long, start long, end long").withColumn("step", F.lit("index")))
    return reduce(DataFrame.unionByName, marks)


def remove_repeats(documents: DataFrame, config: RunIndexConfig | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes' text (`kept`, cut characters replaced)."""
    config = config or RunIndexConfig()
    docs, ids = common.with_uid(documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")))
    docs = docs.select(F.col("uid").alias("doc_id"), "text")  # from here on, ids are uids
    long = docs.where((F.octet_length("text") >= config.length) & F.col("doc_id").isNotNull())
    copies = long.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = common.materialize(copies.where("first < last").select("digest", "first"), "copies")
    later = long.select("doc_id", F.sha2("text", 256).alias("digest")).join(copies, "digest").where("doc_id > first")
    later = common.materialize(later.select("doc_id").distinct(), "later-copies")
    firsts = long.join(later, "doc_id", "left_anti")
    if ids is not None:  # else no id comes twice
        firsts = firsts.dropDuplicates(["doc_id"])
    marks = repeats(firsts, config).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    marks = marks.unionByName(later.select("doc_id", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(1 << 62).alias("end"))).alias("marks")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, spans, out = batch.column(0), batch.column(2), {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            bounds = np.asarray(spans.offsets)
            flat = spans.values
            start, end = (np.asarray(flat.field(x)) for x in ("start", "end"))
            for i, text in enumerate(batch.column(1)):
                raw = text.as_py().encode()
                a, b = bounds[i], bounds[i + 1]
                kept, removed, n = raw, 0, 0
                if spans[i].is_valid and b > a:
                    order = np.argsort(start[a:b], kind="stable")
                    s, e = start[a:b][order], np.maximum.accumulate(np.minimum(end[a:b][order], len(raw)))
                    fresh = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
                    s, e = s[fresh], e[np.append(fresh[1:], len(e)) - 1]
                    kept = b"".join(raw[x:y] for x, y in zip([0, *e.tolist()], [*s.tolist(), len(raw)], strict=True))
                    removed, n = int((e - s).sum()), len(s)
                for name, value in zip(out, (len(raw), removed, n, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")), strict=True):
                    out[name].append(value)
            yield pa.record_batch([ids, *(pa.array(v, pa.int64() if k.startswith("n_") else pa.string()) for k, v in out.items())], ["doc_id", *out])

    full = docs.join(marks, "doc_id", "left").select("doc_id", "text", "marks")
    out = full.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")
    if ids is None:
        return out
    named = out.withColumnRenamed("doc_id", "uid").join(ids, "uid", "left")
    return named.select("doc_id", *out.columns[1:])


def op7_run_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.table(spark, sf_dir, "documents")).drop("kept")
