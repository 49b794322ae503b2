"""Quality classifier: supervised subword embeddings.

Hashed word and character n-gram vectors are averaged over a document and a softmax layer reads the average; both are
trained by numpy stochastic gradient descent on a bounded, documented sample (`max_train_rows` labelled texts, smallest
id hashes first, of `max_train_bytes` together). Word n-grams are taken of the words and of how far back each came
before. Averaging is linear, so for scoring each n-gram's vector is projected on the difference of the two output rows
once: a table of 2**bits floats is broadcast and a document's logit is the mean of its n-grams' entries.

Defined cases: null or empty texts have no n-grams and score from the output bias; very long texts are scored whole;
repeated rows score each on their own; a score of just 0.5 is predicted 1; without labelled rows all score 0.5; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from . import textvec as tv


@dataclass
class QualityConfig:
    bits: int = 16
    dim: int = 12
    rate: float = 1.0
    epochs: int = 6
    word_grams: tuple[int, ...] = (1, 2)
    char_grams: tuple[int, ...] = (3,)
    max_train_rows: int = 6000
    max_train_bytes: int = 64 << 20


@dataclass
class QualityModel:
    table: np.ndarray  # projection of each n-gram's vector on (row of class 1 - row of class 0)
    bias: float
    config: QualityConfig


def recurrence(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every word how far back its text has it before: 0 never, else 1 + the power of two of the distance."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((words, owner))
    back = np.zeros(len(words), np.int64)
    same = (words[order][1:] == words[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    back[order[1:][same]] = np.diff(order)[same]
    return np.where(back > 0, 1 + np.log2(np.maximum(back, 1)).astype(np.int64), 0).astype(np.uint64)


def subwords(data: np.ndarray, offsets: np.ndarray, config: QualityConfig) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts one after another and each text's offsets into them.

    Words are runs of non-spaces, case kept; word n-grams stay inside a text, once of the words themselves and once of
    how far back each came before, which carries over to words that training never saw; character n-grams are byte
    n-grams inside a text that start on a character, blanks read as word ends.
    """
    starts, ends, at = tv.word_spans(data, offsets, tv.NONSPACE)
    shift = np.uint64(64 - config.bits)
    words = tv.word_hash(data, starts, ends)
    parts, cuts = [], []
    for seed, tokens in ((3, words), (4, recurrence(words, at))):
        for n in config.word_grams:
            ok = tv.within(at, n - 1, len(words))
            parts.append((tv.gram_hash(tokens, n, seed=seed) >> shift)[ok])
            cuts.append(np.concatenate([[0], np.cumsum(ok)])[np.minimum(at, len(ok))])
    flat = np.where(tv.NONSPACE[data], data, 32).astype(np.uint32)
    for n in config.char_grams:
        m = len(flat) - n + 1
        if m <= 0:
            continue
        h = flat[:m].copy()
        for j in range(1, n):
            h = h * np.uint32(0x01000193) ^ flat[j : j + m]
        h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - config.bits)
        begin = np.minimum(offsets[:-1], m)
        stop = np.clip(offsets[1:] - n + 1, begin, m)
        keep = np.zeros(m + 1, np.int32)
        np.add.at(keep, begin, 1)
        np.add.at(keep, stop, -1)
        ok = (np.cumsum(keep[:-1]) > 0) & ((data[:m] & 0xC0) != 0x80)
        count = np.concatenate([[0], np.cumsum(ok)])
        parts.append(h[ok])
        cuts.append(np.concatenate([count[begin], [count[-1]]]))
    sizes = sum(np.diff(c) for c in cuts)
    total = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(total[-1], np.int64)
    fill = total[:-1].copy()
    for part, cut in zip(parts, cuts, strict=True):
        span = np.diff(cut)
        where = np.repeat(fill - cut[:-1], span) + np.arange(len(part))
        out[where] = part
        fill += span
    return out, total


def train(texts: pa.Array, labels: np.ndarray, config: QualityConfig) -> QualityModel:
    size = 1 << config.bits
    rng = np.random.default_rng(20240229)
    vectors = rng.uniform(-1 / config.dim, 1 / config.dim, (size, config.dim)).astype(np.float32)
    output = np.zeros((2, config.dim), np.float32)
    bias = np.zeros(2)
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    if len(texts):
        batch = pa.record_batch([pa.array(texts, pa.large_string())], ["text"])
        for a, b, data, offsets in tv.chunks(batch, "text"):
            grams, at = subwords(data, offsets, config)
            for i in range(b - a):
                ids, counts = np.unique(grams[at[i] : at[i + 1]], return_counts=True)
                rows.append((ids.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)))
    order, steps, done = np.arange(len(rows)), max(1, config.epochs * len(rows)), 0
    for _ in range(config.epochs):
        rng.shuffle(order)
        for r in order:
            ids, weight = rows[r]
            rate = config.rate * (1 - done / steps)
            done += 1
            mean = weight @ vectors[ids]
            logit = output @ mean + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[int(labels[r])] -= 1.0
            back = p.astype(np.float32) @ output
            output -= rate * np.outer(p, mean).astype(np.float32)
            bias -= 0.1 * rate * p
            # a document's gradient is spread over its n-grams as the average was; scaled up as only the mean is seen
            vectors[ids] -= (rate * len(ids) ** 0.5) * weight[:, None] * back
    return QualityModel(vectors @ (output[1] - output[0]), float(bias[1] - bias[0]), config)


def fit(documents: DataFrame, labels: DataFrame, config: QualityConfig | None = None) -> QualityModel:
    """labels: doc_id, quality. The caller leaves out the rows that the model must not see."""
    config = config or QualityConfig()
    rows = common.training_rows(documents, labels, "quality", config.max_train_rows, config.max_train_bytes)
    return common.trained(rows, lambda t: train(common.column(t, "text", pa.large_string()), np.asarray(t.column("label"), float), config))


def score_texts(data: np.ndarray, offsets: np.ndarray, model: QualityModel) -> np.ndarray:
    grams, at = subwords(data, offsets, model.config)
    sums = np.concatenate([[0.0], np.cumsum(model.table[grams], dtype=np.float64)])
    mean = (sums[at[1:]] - sums[at[:-1]]) / np.maximum(1, np.diff(at))
    return 1.0 / (1.0 + np.exp(-np.clip(mean + model.bias, -35, 35)))


def score(documents: DataFrame, model: QualityModel) -> DataFrame:
    """One row per row of documents: doc_id, score in 0..1, predicted (score >= 0.5)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [score_texts(data, offsets, shared.value) for _, _, data, offsets in tv.chunks(batch, "text")]
            s = np.concatenate(got) if got else np.zeros(0)
            yield pa.record_batch([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    model = fit(documents, labels.where(common.remainder("doc_id", 3) != 1))
    held = common.remainder("doc_id", 3) == 1
    return score(documents, model).select("doc_id", held.alias("held_out"), "score", "predicted")
