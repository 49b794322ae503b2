"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training runs on a bounded, documented sample (`max_train_rows` labelled texts, smallest id hashes first, of
`max_train_bytes` together); scoring covers every whole text. Every feature takes part, whatever the number of texts:
rare ones are left to the L1 term. Per-coordinate learning rates and the L1 term leave few non-zero weights, and only
these and their places are broadcast.

Defined cases: a null or empty text has no features and scores sigmoid(bias); very long texts are scored whole, chunk
after chunk of the batch; repeated rows and ids score each on their own; a score of just 0.5 is predicted 1; no labelled
row gives a model of zero weights (score 0.5 for all, predicted 1), which rejects nothing; an empty table gives no rows;
other columns are ignored.
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

OUTPUT = "doc_id long, held_out boolean, score double, predicted int"


@dataclass
class ToxicityConfig:
    bits: int = 18
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 10.0
    l2: float = 0.01
    epochs: int = 8
    max_train_rows: int = 12000
    max_train_bytes: int = 64 << 20


@dataclass
class ToxicityModel:
    """Non-zero weights and their places, and the bias, of `rows` texts."""

    places: np.ndarray
    values: np.ndarray
    bias: float
    bits: int
    rows: int

    @property
    def weights(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.places] = self.values
        return out


def gram_features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature) for every word, bigram and skip-gram (one word left out) of lower-cased letter runs."""
    data = tv.LOWER[data]
    starts, ends, at = tv.word_spans(data, offsets, tv.LETTERS)
    words = tv.word_hash(data, starts, ends)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    shift = np.uint64(64 - bits)
    docs, feats = [owner], [tv.gram_hash(words, 1) >> shift]
    for gap in (0, 1):
        ok = tv.within(at, 1 + gap, len(words))
        docs.append(owner[: len(ok)][ok])
        feats.append((tv.gram_hash(words, 2, gap, seed=1 + gap) >> shift)[ok])
    return np.concatenate(docs), np.concatenate(feats).astype(np.int64)


def train(texts: pa.Array, labels: np.ndarray, config: ToxicityConfig) -> ToxicityModel:
    """FTRL-proximal, one text at a time, binary features."""
    size = 1 << config.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last slot is the bias, free of L1
    l1 = np.full(size + 1, config.l1)
    l1[size] = 0.0

    def features() -> Iterator[np.ndarray]:
        for a, b, data, offsets in tv.chunks(pa.record_batch([pa.array(texts, pa.large_string())], ["text"]), "text"):
            docs, feats = gram_features(data, offsets, config.bits)
            pairs = np.unique(docs << config.bits | feats)
            cut = np.searchsorted(pairs, np.arange(b - a + 1) << config.bits)
            pairs = np.bitwise_and(pairs, size - 1).astype(np.int32)
            yield from (pairs[cut[i] : cut[i + 1]] for i in range(b - a))

    rows = [np.append(x, np.int32(size)) for x in features()]

    def weight(i: np.ndarray) -> np.ndarray:
        w = np.sign(z[i]) * l1[i] - z[i]
        w /= (config.beta + np.sqrt(n[i])) / config.alpha + config.l2
        return np.where(np.abs(z[i]) <= l1[i], 0.0, w)

    for _ in range(config.epochs):
        for x, y in zip(rows, labels, strict=True):
            w = weight(x)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            if abs(g) < 1e-4:
                continue
            old = n[x]
            n[x] = old + g * g
            z[x] += g - (np.sqrt(n[x]) - np.sqrt(old)) / config.alpha * w
    w = weight(np.arange(size + 1))
    places = np.flatnonzero(w[:size]).astype(np.int32)
    return ToxicityModel(places, w[places].astype(np.float32), float(w[size]), config.bits, len(rows))


def fit(documents: DataFrame, labels: DataFrame, config: ToxicityConfig | None = None) -> ToxicityModel:
    """labels: doc_id, toxic. The caller leaves out the rows that the model must not see."""
    config = config or ToxicityConfig()
    rows = common.training_rows(documents, labels, "toxic", config.max_train_rows, config.max_train_bytes)
    return common.trained(rows, lambda t: train(common.column(t, "text", pa.large_string()), np.asarray(t.column("label"), float), config))


def score_texts(data: np.ndarray, offsets: np.ndarray, model: ToxicityModel) -> np.ndarray:
    weights = model.weights
    docs, feats = gram_features(data, offsets, model.bits)
    hit = np.flatnonzero(weights[feats])
    pairs = np.unique(docs[hit] << model.bits | feats[hit])
    total = np.bincount(pairs >> model.bits, weights[pairs & ((1 << model.bits) - 1)], len(offsets) - 1)
    return 1.0 / (1.0 + np.exp(-np.clip(total + model.bias, -35, 35)))


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per row of documents: doc_id, score in 0..1, predicted (score >= 0.5)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [score_texts(data, offsets, shared.value) for _, _, data, offsets in tv.chunks(batch, "text")]
            s = np.concatenate(got) if got else np.zeros(0)
            yield pa.record_batch([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_clean(documents: DataFrame, model: ToxicityModel, below: float = 0.5) -> DataFrame:
    """The rows of documents, all columns as they are, whose text scores below `below`; all of them without a training row."""
    if not model.rows:
        return documents
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tv.chunks(batch, "text"):
                yield batch.slice(a, b - a).filter(pa.array(score_texts(data, offsets, shared.value) < below))

    return documents.mapInArrow(run, documents.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    model = fit(documents, labels.where(common.remainder("doc_id", 5) != 0))
    held = common.remainder("doc_id", 5) == 0
    return score(documents, model).select("doc_id", held.alias("held_out"), "score", "predicted")
