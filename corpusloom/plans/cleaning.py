"""Cleaning, statistics and gate queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as c
from ..functions import stats as s
from ..functions.language import PROFILES, SQL_PROFILE, confidences, language_profile, sql_confidences, top_language
from ..functions.lines import LineRules, clean_lines
from ..operators.tables import load, spread
from .registry import query


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {_q(pattern)}, {_q(to)}, 'g')"


def sql_markup(x: str) -> str:
    for a, b in c.MARKUP:
        b = b.replace("\n", "' || chr(10) || '") if "\n" in b else b.replace("'", "''")
        x = f"replace({x}, {_q(a)}, '{b}')"
    return x


def sql_control(x: str) -> str:
    return _sub(_sub(x, r"[\r\n\t]+", "."), r"\p{C}", "")


def sql_punctuation(x: str) -> str:
    return _sub(f"translate({x}, {_q(c.PUNCTUATION_FROM)}, {_q(c.PUNCTUATION_TO)})", f"[^{c.KEPT}]", " ")


def sql_urls(x: str) -> str:
    return _sub(_sub(x, c.ANCHORS, ""), c.URL, "")


def sql_handles(x: str) -> str:
    bare = _sub(f"replace({x}, '@<user>', '')", c.HANDLE.removeprefix("(?U)"), "")
    return f"CASE WHEN contains({x}, '@') THEN trim({_sub(_sub(bare, chr(92) + 's+', ''), '(.)', chr(92) + '1 ')}) ELSE {x} END"


def sql_punctuation_runs(x: str) -> str:
    for p in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
        x = _sub(x, f"[{p}]+" if p not in "\\]^[" else f"\\{p}+", p if p != "\\" else "\\\\")
    return x


def sql_spaces(x: str) -> str:
    return f"trim({_sub(x, chr(92) + 's+', ' ')})"


def sql_native(column: str) -> tuple[str, str]:
    """The chain without entities and repeated words as (CTEs, last CTE); `src` holds k and t."""
    steps = [sql_markup, sql_control, sql_punctuation, lambda x: _sub(x, c.NEWS_TAGS, ""), sql_urls, sql_handles, sql_punctuation_runs, sql_spaces]
    ctes = [f"s{i + 1} AS MATERIALIZED (SELECT k, {f('t')} AS t FROM {'src' if i == 0 else f's{i}'})" for i, f in enumerate(steps)]
    return ", ".join(ctes), f"s{len(steps)}"


DOCS = "SELECT doc_id AS k, text AS t FROM documents"
CHAIN, LAST = sql_native("t")
CLEAN_DOCS = f"WITH src AS ({DOCS}), {CHAIN}"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages as (kind, id, text)."""
    docs = load(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = load(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return spread(docs, "id").unionByName(spread(pages, "id"))


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(load(spark, sf_dir, "documents").select("doc_id", *columns), "doc_id")


BOTH = "SELECT 'document' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'page', page_id, html FROM pages"


def _step(name: str, function, sql: str | None) -> None:
    @query(name, f"SELECT kind, id, {sql} AS text FROM ({BOTH})" if sql else None)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _texts(spark, sf_dir).select("kind", "id", function(F.col("text")).alias("text"))


_step("clean_fix_html", c.fix_markup, sql_markup("text"))
_step("clean_control_chars", lambda x: c.drop_control(c.control_to_stop(x)), sql_control("text"))
_step("clean_standardise_punc", c.unify_punctuation, sql_punctuation("text"))
_step("clean_strip_tags_urls", lambda x: c.drop_urls(c.drop_news_tags(F.replace(x, F.lit("\n"), F.lit(" ")))), sql_urls(_sub("replace(text, chr(10), ' ')", c.NEWS_TAGS, "")))
_step("clean_punct_runs", c.collapse_punctuation, sql_punctuation_runs("text"))
_step("clean_multi_space", c.collapse_spaces, sql_spaces("text"))
_step("clean_symbols_intended", c.drop_symbols, _sub("text", r"\p{So}", ""))


@query("clean_unicode_symbols_strict", f"SELECT kind, id, text FROM ({BOTH})")
def clean_unicode_symbols_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict symbol step removes nothing."""
    return _texts(spark, sf_dir)


@query("clean_usernames_strict", f"SELECT doc_id, {sql_handles('text')} AS text FROM (SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents) WHERE contains(text, '@')")
def clean_usernames_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").where(F.col("text").contains("@"))
    return rows.select("doc_id", c.drop_handles(F.replace("text", F.lit("\n"), F.lit(" "))).alias("text"))


@query("clean_html_unescape")
def clean_html_unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select("page_id", c.unescape(F.col("html")).alias("html"))


@query("clean_duplicate_words")
def clean_duplicate_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, "text").select("doc_id", c.collapse_words(F.col("text")).alias("text"))


@query("clean_full_strict")
def clean_full_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("kind", "id", c.clean(F.col("text"), "strict").alias("text"))


@query("clean_full_intended")
def clean_full_intended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("kind", "id", c.clean(F.col("text"), "intended").alias("text"))


@query("clean_no_backref", f"WITH src AS (SELECT struct_pack(kind := kind, id := id) AS k, text AS t FROM ({BOTH})), {CHAIN} SELECT k.kind AS kind, k.id AS id, t AS text FROM {LAST}")
def clean_no_backref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("kind", "id", c.clean(F.col("text"), "native").alias("text"))


def cleaned(spark: SparkSession, sf_dir: str, *also: str, mode: str = "native") -> DataFrame:
    """Documents' id, text and the columns `also`, with clean_text, clean_words and the statistics of the cleaned text.

    The chain is evaluated once per row: a lambda binds its result, and as the columns come out of a generator no
    predicate on them is pushed below it with a copy of the chain.
    """
    docs = _documents(spark, sf_dir, "text", *also)
    entry = c.let(
        c.clean(F.col("text"), mode),
        lambda t: F.struct(t.alias("clean_text"), s.words(t).alias("clean_words"), *(v.alias(k) for k, v in s.text_stats(t).items())),
    )
    return docs.select("*", F.inline(F.array(entry)))


STATS = f"""{CLEAN_DOCS}, n AS (SELECT k AS doc_id, t, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS clean_words,
len(regexp_extract_all(t, '{s.LETTERS}')) AS alphabet_len, len(regexp_extract_all(t, '{s.DIGITS}')) AS number_len,
len(regexp_extract_all(t, '{s.CAPITALS}')) AS upper_len, length(t) AS total_len FROM {LAST}),
st AS (SELECT *, alphabet_len / nullif(total_len, 0) AS alphabet_ratio, number_len / nullif(total_len, 0) AS number_ratio, upper_len / nullif(total_len, 0) AS upper_ratio FROM n),
g AS (SELECT *, CASE WHEN clean_words < 20 THEN 'short' WHEN NOT coalesce(alphabet_ratio > 0.75, false) THEN 'alphabet'
WHEN NOT (upper_ratio < 0.10) THEN 'upper' WHEN NOT (number_ratio < 0.05) THEN 'number' ELSE 'kept' END AS reason FROM st)"""


@query("text_stats", f"{STATS} SELECT doc_id, clean_words, alphabet_len, number_len, upper_len, total_len, round(alphabet_ratio, 6) AS alphabet_ratio, round(number_ratio, 6) AS number_ratio, round(upper_ratio, 6) AS upper_ratio FROM st")
def text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = [F.round(f"{k}_ratio", 6).alias(f"{k}_ratio") for k in ("alphabet", "number", "upper")]
    return cleaned(spark, sf_dir).select("doc_id", "clean_words", "alphabet_len", "number_len", "upper_len", "total_len", *rounded)


@query("quality_gate", f"{STATS} SELECT doc_id, t AS clean_text, clean_words, total_len FROM g WHERE reason = 'kept'")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned(spark, sf_dir).where(s.Gate().reason() == "kept")
    return rows.select("doc_id", "clean_text", "clean_words", "total_len")


@query("reject_reasons", f"{STATS} SELECT reason, count(*) AS n FROM g GROUP BY reason")
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).groupBy(s.Gate().reason().alias("reason")).agg(F.count("*").alias("n"))


@query("gate_by_lang", f"{STATS} SELECT lang, count(*) AS n, count(*) FILTER (reason = 'kept') AS kept FROM g JOIN documents USING (doc_id) GROUP BY lang")
def gate_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir, "lang").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(s.Gate().reason() == "kept").alias("kept"))


@query("stage_row_counts", f"{STATS} SELECT count(*) AS loaded, count(*) FILTER (clean_words >= 20) AS long_enough, count(*) FILTER (reason = 'kept') AS kept FROM g")
def stage_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after each stage, in one pass."""
    rows = cleaned(spark, sf_dir)
    return rows.agg(F.count("*").alias("loaded"), F.count_if(F.col("clean_words") >= 20).alias("long_enough"), F.count_if(s.Gate().reason() == "kept").alias("kept"))


PROFILED = sql_confidences("(SELECT doc_id, t FROM g)", "doc_id", "t")
TARGET = s.Gate(language="en", confidence_above=0.65)


@query("lang_confidences", f"SELECT doc_id, {', '.join(f'round({x}, 6) AS {x}' for x in PROFILES)}, label, round(confidence, 6) AS confidence FROM ({sql_confidences('documents', 'doc_id', 'text')})")
def lang_confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A confidence for every language of a text, and the best one's label."""
    rows = _documents(spark, sf_dir, "text").select("doc_id", confidences(F.col("text")).alias("c"), top_language(F.col("text")).alias("top"))
    return rows.select("doc_id", *(F.round(f"c.{x}", 6).alias(x) for x in PROFILES), "top.label", F.round("top.confidence", 6).alias("confidence"))


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cleaned() with lang and lang_confidence of the cleaned text, null where the gate fails before; a detector of any model may give them instead."""
    found = F.when(s.Gate().reason() == "kept", top_language(F.col("clean_text")))
    return cleaned(spark, sf_dir).select("*", F.inline(F.array(found)).alias("lang", "lang_confidence"))


@query("language_gate", f"{STATS}, l AS ({PROFILED}) SELECT doc_id, label AS lang, round(confidence, 6) AS lang_confidence, clean_words FROM g JOIN l USING (doc_id) WHERE reason = 'kept' AND label = 'en' AND confidence > 0.65")
def language_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole gate: words, ratios, language and its confidence, all bounds strict."""
    rows = _identified(spark, sf_dir).where(TARGET.reason() == "kept")
    return rows.select("doc_id", "lang", F.round("lang_confidence", 6).alias("lang_confidence"), "clean_words")


@query("language_reject_reasons", f"{STATS}, l AS ({PROFILED}) SELECT CASE WHEN reason = 'kept' AND NOT (label = 'en' AND confidence > 0.65) THEN 'language' ELSE reason END AS reason, count(*) AS n FROM g JOIN l USING (doc_id) GROUP BY 1")
def language_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identified(spark, sf_dir).groupBy(TARGET.reason().alias("reason")).agg(F.count("*").alias("n"))


@query("lang_fallback", SQL_PROFILE)
def lang_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_profile(_documents(spark, sf_dir, "text"))


_RULES = LineRules()


@query("line_clean", _RULES.sql("documents", "doc_id", "text"))
def line_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, "text").select("doc_id", *clean_lines(F.col("text"), _RULES))


@query("line_clean_reasons", f"SELECT reason, count(*) AS n FROM ({_RULES.sql('documents', 'doc_id', 'text')}) GROUP BY reason")
def line_clean_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir, "text").select(*clean_lines(F.col("text"), _RULES))
    return rows.groupBy("reason").agg(F.count("*").alias("n"))


@query("sentence_counts", r"SELECT doc_id, len(regexp_extract_all(text, '[.!?]+(?:\s|$)')) AS sentences FROM documents")
def sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", s.sentence_count(F.col("text")).alias("sentences"))


@query("sentence_total", r"SELECT lang, CAST(sum(len(regexp_extract_all(text, '[.!?]+(?:\s|$)'))) AS BIGINT) AS sentences FROM documents GROUP BY lang")
def sentence_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").groupBy("lang").agg(F.sum(s.sentence_count(F.col("text"))).alias("sentences"))
