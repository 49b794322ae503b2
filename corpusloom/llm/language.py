"""Language identification by hyperdimensional profiles.

Every letter class has a fixed random +-1 vector. A letter trigram is bound as rho^2(first) * rho(middle) * last, rho a
rotation by one place; a document bundles (adds) the vectors of all its trigrams; a language's prototype bundles the
unit vectors of its training documents. A document gets the language whose prototype has the largest cosine.

Words are padded by blanks, so a text of one letter has a trigram. Training uses a bounded, documented sample
(`max_train_rows` texts, smallest id hashes first, of `max_train_bytes` together); prediction reads whole texts of any
length.

Defined cases: null texts and texts without a letter give `und` and score 0; ties go to the smaller language name;
without training rows every text is `und`; repeated rows are predicted each; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from . import textvec as tv

CLASSES = 64  # blank, a-z, and 37 classes that the other letters share by a rule
COUNTS = 1 << 20  # entries of a table of texts by kinds of trigrams; more texts are split, one text has at most CLASSES**3


@dataclass
class LanguageConfig:
    dim: int = 1024
    max_train_rows: int = 3000
    max_train_bytes: int = 32 << 20


@dataclass
class LanguageModel:
    languages: list[str]
    prototypes: np.ndarray  # unit rows, one per language
    dim: int


@functools.cache
def letter_classes() -> np.ndarray:
    """Class of every code point after lower-casing; 0 for what isn't a letter."""
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            out[cp] = low - 96 if 97 <= low <= 122 else 27 + low % (CLASSES - 27)
    return out


@functools.cache
def letter_vectors(dim: int) -> np.ndarray:
    bits = np.unpackbits(tv.rule_values(CLASSES * dim // 64, 77).view(np.uint8)).reshape(CLASSES, dim)
    return (bits.astype(np.int8) * 2 - 1).astype(np.int8)


def trigram_vectors(codes: np.ndarray, dim: int) -> np.ndarray:
    """Bound vectors of trigrams given as (first * CLASSES + middle) * CLASSES + last."""
    base = letter_vectors(dim)
    first, middle = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    return first[codes // CLASSES**2] * middle[codes // CLASSES % CLASSES] * base[codes % CLASSES]


def bundle(out: np.ndarray, code: np.ndarray, owner: np.ndarray) -> None:
    """Add the vectors of trigrams to the rows of their texts, owner ascending from 0; halves the texts to bound memory."""
    texts, dim = out.shape
    seen = np.zeros(CLASSES**3, bool)
    seen[code] = True
    kinds = np.flatnonzero(seen)
    if texts > 1 and texts * len(kinds) > COUNTS:
        half = texts // 2
        cut = np.searchsorted(owner, half)
        bundle(out[:half], code[:cut], owner[:cut])
        bundle(out[half:], code[cut:], owner[cut:] - half)
        return
    column = np.cumsum(seen) - 1
    counts = np.bincount(owner * len(kinds) + column[code], minlength=texts * len(kinds)).reshape(texts, len(kinds))
    for a in range(0, len(kinds), 2048):
        out += counts[:, a : a + 2048].astype(np.float32) @ trigram_vectors(kinds[a : a + 2048], dim).astype(np.float32)


def document_vectors(data: np.ndarray, offsets: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vectors (a row per text) and the number of letters of each text."""
    texts = len(offsets) - 1
    padded = np.insert(data, offsets, 10)
    points = np.frombuffer(padded.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    classes = letter_classes()[points]
    begin = np.concatenate([[0], np.cumsum((padded & 0xC0) != 0x80)])[offsets + np.arange(texts + 1)]
    middle = np.flatnonzero(classes)
    code = (classes[middle - 1].astype(np.int64) * CLASSES + classes[middle]) * CLASSES + classes[middle + 1]
    at = np.searchsorted(middle, begin)
    out = np.zeros((texts, dim), np.float32)
    bundle(out, code, np.repeat(np.arange(texts), np.diff(at)))
    return out, np.diff(at)


def unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1)


def train(texts: pa.Array, langs: list[str], config: LanguageConfig) -> LanguageModel:
    languages = sorted(set(langs))
    index = {x: i for i, x in enumerate(languages)}
    sums = np.zeros((len(languages), config.dim))
    if languages:
        batch = pa.record_batch([pa.array(texts, pa.large_string())], ["text"])
        for a, b, data, offsets in tv.chunks(batch, "text"):
            np.add.at(sums, [index[x] for x in langs[a:b]], unit(document_vectors(data, offsets, config.dim)[0]))
    return LanguageModel(languages, unit(sums).astype(np.float32), config.dim)


def fit(documents: DataFrame, config: LanguageConfig | None = None) -> LanguageModel:
    """documents: doc_id, text, lang, only the rows that the model may see."""
    config = config or LanguageConfig()
    known = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    ids = common.drawn(known.select("doc_id").distinct(), config.max_train_rows)
    rows = common.sampled(known, ids, config.max_train_bytes, "lang").select("text", "lang")
    return common.trained(rows, lambda t: train(common.column(t, "text", pa.large_string()), t.column("lang").to_pylist(), config))


def predict_texts(data: np.ndarray, offsets: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language, or -1, and the cosine clipped to 0..1."""
    vectors, letters = document_vectors(data, offsets, model.dim)
    if not model.languages:
        return np.full(len(letters), -1), np.zeros(len(letters))
    cosine = unit(vectors) @ model.prototypes.T
    best = np.where(letters > 0, cosine.argmax(axis=1), -1)
    return best, np.where(letters > 0, np.clip(cosine.max(axis=1), 0, 1), 0.0).astype(float)


def predict(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per row of documents: doc_id, lang_pred, score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, "und"], object)
        for batch in batches:
            got = [predict_texts(data, offsets, shared.value) for _, _, data, offsets in tv.chunks(batch, "text", tv.CHUNK_BYTES // 2)]
            best = np.concatenate([x[0] for x in got]) if got else np.zeros(0, int)
            score = np.concatenate([x[1] for x in got]) if got else np.zeros(0)
            yield pa.record_batch([batch.column(0), pa.array(names[best], pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents")
    held = common.remainder("doc_id", 4) == 2
    model = fit(documents.where(~held))
    return predict(documents, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
