"""Language-model preparation queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lm
from ..operators.tables import load, with_row_index
from .registry import query

INDEXED = "n AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS row_index, count(*) OVER () AS total FROM documents)"
WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')"
LENGTH = 128
MAX_LENGTH = 1024  # tokens of a line; words in place of a tokeniser have no model maximum, so the reference's own bound holds


@query("split_positional", f"WITH {INDEXED} SELECT doc_id, CASE WHEN row_index < round(total * 5 / 100) THEN 'validation' ELSE 'train' END AS split FROM n")
def split_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.split_by_position(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", 5).select("doc_id", "split")


@query(
    "group_texts_chunks",
    f"""WITH {INDEXED}, t AS (SELECT row_index // 200 AS batch, row_index, unnest({WORDS}) AS token, generate_subscripts({WORDS}, 1) AS i FROM n),
    p AS (SELECT batch, token, row_number() OVER (PARTITION BY batch ORDER BY row_index, i) - 1 AS place, count(*) OVER (PARTITION BY batch) AS total FROM t),
    k AS (SELECT batch, place // {LENGTH} AS chunk, token, place FROM p WHERE total < {LENGTH} OR place < total // {LENGTH} * {LENGTH})
    SELECT batch, chunk, count(*) AS n, md5(string_agg(token, ' ' ORDER BY place)) AS digest FROM k GROUP BY batch, chunk""",
)
def group_texts_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    rows = lm.chunked(docs, "doc_id", lm.words(F.col("text")), LENGTH, batch_rows=200, separator=" ")
    return rows.select("batch", "chunk", F.size("tokens").cast("long").alias("n"), F.md5(F.array_join("tokens", " ")).alias("digest"))


@query(
    "tokenise_truncate_pad",
    rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
    t AS (SELECT doc_id, line_no, list_filter(string_split_regex(line, '\s+'), lambda x: x <> '')[1:{MAX_LENGTH}] AS k FROM l WHERE trim(line) <> '')
    SELECT doc_id, line_no, array_to_string(list_concat(k, list_transform(range({MAX_LENGTH} - len(k)), lambda i: '[PAD]')), ' ') AS tokens, len(k) AS n_tokens FROM t""",
)
def tokenise_truncate_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each non-blank line as at most MAX_LENGTH tokens, filled up; the mask is the number of real ones."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.trim("line") != "")
    k = lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), lm.words(F.col("line")).alias("k"))
    padded = F.array_join(lm.truncated_padded(F.col("k"), MAX_LENGTH), " ")
    return k.select("doc_id", "line_no", padded.alias("tokens"), F.least(F.size("k"), F.lit(MAX_LENGTH)).cast("long").alias("n_tokens"))


@query(
    "tokenise_special_mask",
    rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
    t AS (SELECT doc_id, line_no, list_filter(string_split_regex(line, '\s+'), lambda x: x <> '')[1:{MAX_LENGTH - 2}] AS k FROM l WHERE trim(line) <> '')
    SELECT doc_id, line_no, md5('[CLS] ' || array_to_string(list_concat(k, ['[SEP]'], list_transform(range({MAX_LENGTH - 2} - len(k)), lambda i: '[PAD]')), ' ')) AS digest,
    {MAX_LENGTH} - len(k) AS n_special FROM t""",
)
def tokenise_special_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as rows of MAX_LENGTH tokens with marks, and the mask of what is no text."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.trim("line") != "")
    rows = lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.inline(F.array(lm.with_specials(lm.words(F.col("line")), MAX_LENGTH))).alias("tokens", "special"))
    return rows.select("doc_id", "line_no", F.md5(F.array_join("tokens", " ")).alias("digest"), F.aggregate("special", F.lit(0), lambda a, x: a + x).cast("long").alias("n_special"))


@query("tokenise_whole_text", f"SELECT doc_id, md5(array_to_string(list_concat(['[CLS]'], {WORDS}, ['[SEP]']), ' ')) AS digest, len({WORDS}) + 2 AS n_tokens FROM documents")
def tokenise_whole_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text whole, for concatenation and chunks later; the tokeniser is any model's, here one that splits at blanks."""
    tokens = lm.tokeniser(_splitting)(F.col("text"))
    rows = load(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", tokens.alias("k")).select("doc_id", lm.with_specials(F.col("k"))["tokens"].alias("tokens"))
    return rows.select("doc_id", F.md5(F.array_join("tokens", " ")).alias("digest"), F.size("tokens").cast("long").alias("n_tokens"))


def _splitting() -> object:
    return lambda texts: [re.findall(r"[^ \t\n\r\f\v]+", t) for t in texts]


@query(
    "mask_tokens",
    f"""WITH t AS (SELECT doc_id, unnest({WORDS}) AS token, generate_subscripts({WORDS}, 1) - 1 AS i FROM documents)
    SELECT doc_id, string_agg(CASE WHEN CAST('0x' || left(md5(doc_id || '|' || i), 7) AS BIGINT) % 100 < 15 THEN '[MASK]' ELSE token END, ' ' ORDER BY i) AS tokens FROM t GROUP BY doc_id""",
)
def mask_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lm.words(F.col("text"))
    rows = load(spark, sf_dir, "documents").where(F.size(t) > 0)
    return rows.select("doc_id", F.array_join(lm.masked(t, F.col("doc_id")), " ").alias("tokens"))


@query("perplexity", "SELECT event_type, round(exp(avg(value / 100)), 6) AS perplexity FROM events GROUP BY event_type")
def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.exp(F.avg(F.col("value") / 100)), 6).alias("perplexity"))


@query("shard_assignment", "WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) SELECT lpad(CAST(i // 300 + 1 AS VARCHAR), 12, '0') AS shard, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM n GROUP BY 1")
def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_row_index(load(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    shard = F.lpad((F.floor(F.col("row_index") / 300) + 1).cast("string"), 12, "0")
    return rows.groupBy(shard.alias("shard")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query("shard_window_strict", "WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) SELECT doc_id, i // 500 AS part FROM n WHERE i % 500 < 50")
def shard_window_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant whose step is ten times its window."""
    rows = with_row_index(load(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return rows.where("row_index % 500 < 50").select("doc_id", F.floor(F.col("row_index") / 500).alias("part"))


def _lower() -> object:
    return lambda texts: [t.lower() for t in texts]


@query("translate_stub", "SELECT conv_id, turn, lower(text) AS translated, lower(role || ': ' || text) AS original FROM conversations")
def translate_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batched model interface with a stand-in model over two columns of whole texts; keys pass through. A limit in tokens is the loaded model's."""
    translate = lm.row_translator(_lower, ["translated", "original"], batch=256)
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.concat_ws(": ", "role", "text").alias("original"))
    return rows.select("conv_id", "turn", translate("text", "original").alias("t")).select("conv_id", "turn", "t.translated", "t.original")
