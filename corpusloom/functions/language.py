"""Language of a text from a profile of frequent words, natively; a model may take its place through the same columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent words by language.
PROFILES = {
    "de": ("der", "die", "und", "das", "ist", "nicht", "von", "ein", "zu", "mit"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "with", "was"),
    "es": ("el", "los", "del", "y", "por", "una", "con", "para", "las", "su"),
    "fr": ("le", "les", "des", "et", "du", "dans", "pour", "qui", "une", "est"),
}


def language_profile(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, hits): the language with most profile words, ties by name; 'und' without any."""
    tokens = F.split(F.lower(text), r"[^\p{L}]+")
    scores = F.array(*(F.struct((-F.size(F.filter(tokens, _in(words)))).alias("rank"), F.lit(lang).alias("lang")) for lang, words in PROFILES.items()))
    best = df.select(key, F.array_min(scores).alias("best"))
    return best.select(key, F.when(F.col("best.rank") < 0, F.col("best.lang")).otherwise("und").alias("lang_pred"), (-F.col("best.rank")).cast("long").alias("hits"))


def confidences(text: Column) -> Column:
    """Share of each language among the profile words of a text, as a struct with a field for each; null without any."""
    known = tuple(dict.fromkeys(w for words in PROFILES.values() for w in words))
    tokens = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), _in(known))  # once, the languages then look at these few
    hits = F.transform(F.array(tokens), lambda t: F.struct(*(F.size(F.filter(t, _in(words))).alias(lang) for lang, words in PROFILES.items())))
    hits = F.element_at(hits, 1)

    def shares(h: Column) -> Column:
        total = sum((h[lang] for lang in PROFILES), F.lit(0))
        return F.struct(*(F.try_divide(h[lang].cast("double"), total.cast("double")).alias(lang) for lang in PROFILES))

    return F.element_at(F.transform(F.array(hits), shares), 1)


def top_language(text: Column, prefix: str = "") -> Column:
    """struct<label, confidence>: the language of the largest share, ties by name; 'und' with 0 without profile words.

    The columns that a model behind detector() gives, natively.
    """

    def best(c: Column) -> Column:
        ranked = F.array_min(F.array(*(F.struct((-c[lang]).alias("less"), F.lit(f"{prefix}{lang}").alias("label")) for lang in sorted(PROFILES))))
        known = c[next(iter(PROFILES))].isNotNull()
        return F.struct(F.when(known, ranked["label"]).otherwise(f"{prefix}und").alias("label"), F.when(known, -ranked["less"]).otherwise(0.0).alias("confidence"))

    return F.element_at(F.transform(F.array(confidences(text)), best), 1)


def _in(words: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda w: w.isin(*words)


def _sql() -> str:
    counts = ", ".join(f"len(list_filter(w, lambda x: x IN {words})) AS {lang}" for lang, words in PROFILES.items())
    best = "greatest(" + ", ".join(PROFILES) + ")"
    cases = " ".join(f"WHEN {lang} = {best} THEN '{lang}'" for lang in PROFILES)
    return f"SELECT doc_id, CASE WHEN {best} = 0 THEN 'und' {cases} END AS lang_pred, CAST({best} AS BIGINT) AS hits FROM (SELECT doc_id, {counts} FROM (SELECT doc_id, string_split_regex(lower(text), '[^\\p{{L}}]+') AS w FROM documents))"


SQL_PROFILE = _sql()


def sql_confidences(source: str, key: str, text: str) -> str:
    """SELECT of key, a share for each language, label and confidence; source: a table or subquery."""
    hits = ", ".join(f"len(list_filter(w, lambda x: x IN {words})) AS h_{lang}" for lang, words in PROFILES.items())
    total = " + ".join(f"h_{lang}" for lang in PROFILES)
    best = "greatest(" + ", ".join(f"h_{lang}" for lang in PROFILES) + ")"
    cases = " ".join(f"WHEN h_{lang} = {best} THEN '{lang}'" for lang in sorted(PROFILES))
    shares = ", ".join(f"h_{lang} / nullif({total}, 0) AS {lang}" for lang in PROFILES)
    return f"SELECT {key}, {shares}, CASE WHEN {best} = 0 THEN 'und' {cases} END AS label, coalesce({best} / nullif({total}, 0), 0) AS confidence FROM (SELECT {key}, {hits} FROM (SELECT {key}, string_split_regex(lower({text}), '[^\\p{{L}}]+') AS w FROM {source}))"


def detector(load_model: Callable[[], Callable[[list[str]], list[tuple[str, float]]]]):
    """A column function text -> struct<label, confidence> of any model; the model is loaded once per Python worker."""

    @F.pandas_udf("label string, confidence double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for texts in batches:
            yield pd.DataFrame(model(texts.fillna("").tolist()), columns=["label", "confidence"])

    return predict
