"""Exact and near duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats as s
from ..operators import lsh
from ..operators.tables import load, salted_join, spread, stored
from .registry import query

HASH = r"md5(regexp_replace(text, '^\s+|\s+$', '', 'g'))"
HASHED = f"h AS (SELECT *, {HASH} AS hash FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY doc_id) AS rn FROM h)"


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").withColumn("hash", s.content_hash(F.col("text")))


def first_of_each(df: DataFrame) -> DataFrame:
    """The first document of every hash. An aggregate combines map-side, so a hash of very many rows is no hot task."""
    first = df.groupBy("hash").agg(F.min("doc_id").alias("doc_id"))
    return df.join(first.select("doc_id"), "doc_id", "left_semi")


@query("exact_hash", f"SELECT doc_id, {HASH} AS hash FROM documents")
def exact_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed(spark, sf_dir).select("doc_id", "hash")


@query("exact_dedup", f"WITH {HASHED} SELECT doc_id, hash, n_chars FROM r WHERE rn = 1")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_of_each(hashed(spark, sf_dir)).select("doc_id", "hash", "n_chars")


@query("dup_rows", f"WITH {HASHED} SELECT doc_id, hash FROM r WHERE rn > 1")
def dup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hashed(spark, sf_dir).select("doc_id", "hash")
    first = rows.groupBy("hash").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    return rows.join(first, "doc_id", "left_anti")


@query("dup_fraction", f"SELECT count(*) AS total, count(DISTINCT {HASH}) AS uniques, round(1 - count(DISTINCT {HASH}) / count(*), 6) AS dup_fraction FROM documents")
def dup_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = hashed(spark, sf_dir).groupBy("hash").agg(F.count("*").alias("n")).agg(F.sum("n").alias("total"), F.count("*").alias("uniques"))
    return sums.select("total", "uniques", F.round(1 - F.try_divide(F.col("uniques"), F.col("total")), 6).alias("dup_fraction"))


@query("dup_group_sizes", f"WITH h AS (SELECT {HASH} AS hash, count(*) AS n FROM documents GROUP BY 1) SELECT n AS copies, count(*) AS groups FROM h GROUP BY n")
def dup_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed(spark, sf_dir).groupBy("hash").agg(F.count("*").alias("copies")).groupBy("copies").agg(F.count("*").alias("groups"))


TOKENS = "list_filter(string_split_regex(text, '[^A-Za-z_0-9]'), lambda x: length(x) > 0)"


@query("token_sets", f"SELECT doc_id, len({TOKENS}) AS n_tokens, len(list_distinct({TOKENS})) AS n_distinct FROM documents")
def token_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = s.tokens(F.col("text"))
    return load(spark, sf_dir, "documents").select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"))


def _candidates_sql(config: lsh.LshConfig) -> str:
    p = lsh.PRIME
    return f"""t AS (SELECT doc_id AS id, list_distinct({TOKENS}) AS tokens FROM documents WHERE len({TOKENS}) >= {config.min_tokens}),
    u AS (SELECT id, CAST('0x' || left(md5(w), 7) AS BIGINT) AS h FROM (SELECT id, unnest(tokens) AS w FROM t)),
    i AS (SELECT range AS i, (1000003 * (range + 1) * (range + 7)) % {p - 1} + 1 AS a, (7919 * (range + 1) * (range + 1) + 104729) % {p} AS b FROM range({config.slots})),
    sg AS (SELECT id, i, min((a * h + b) % {p}) AS v FROM u, i GROUP BY id, i),
    bd AS (SELECT id, i // {config.rows} AS band, string_agg(v, ',' ORDER BY i) AS k FROM sg GROUP BY id, band),
    cand AS (SELECT DISTINCT x.id AS a, y.id AS b FROM bd x JOIN bd y ON x.band = y.band AND x.k = y.k AND x.id < y.id),
    cls AS (SELECT id, min(id) OVER (PARTITION BY array_to_string(list_sort(tokens), ' ')) AS rep FROM t),
    pair AS (SELECT a, b, 'candidate' AS kind FROM cand JOIN cls x ON x.id = a AND x.rep = a JOIN cls y ON y.id = b AND y.rep = b UNION ALL SELECT rep, id, 'copy' FROM cls WHERE id <> rep)"""


LOW, HIGH = lsh.LshConfig(), lsh.LshConfig(threshold=0.85, bands=13, rows=19)
LOW_SQL = _candidates_sql(LOW)
SIMILAR = "SELECT a, b, kind, round(len(list_intersect(x.tokens, y.tokens)) / len(list_distinct(list_concat(x.tokens, y.tokens))), 6) AS similarity FROM pair JOIN t x ON x.id = a JOIN t y ON y.id = b"


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(lsh.tokenised(spread(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")), "tokens")


def _pairs(index: lsh.Index) -> DataFrame:
    """(a, b, kind): candidates among representatives, and the copies of each of these."""
    return lsh.candidate_pairs(index).withColumn("kind", F.lit("candidate")).unionByName(lsh.copies(index).withColumn("kind", F.lit("copy")))


@query("lsh_candidates", f"WITH {LOW_SQL} SELECT a, b, kind FROM pair")
def lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(lsh.build_index(_tokens(spark, sf_dir), LOW))


@query("lsh_candidates_085", f"WITH {_candidates_sql(HIGH)} SELECT a, b, kind FROM pair")
def lsh_candidates_085(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(lsh.build_index(_tokens(spark, sf_dir), HIGH))


@query("jaccard_pairs", f"WITH {LOW_SQL} SELECT * FROM ({SIMILAR}) WHERE similarity >= 0.75")
def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Representatives that reach the threshold, and copies, which are as similar as can be."""
    docs = _tokens(spark, sf_dir)
    index = lsh.build_index(docs, LOW)
    similar = lsh.similar_pairs(index, docs, 0.75).select("a", "b", F.lit("candidate").alias("kind"), F.round("similarity", 6).alias("similarity"))
    return similar.unionByName(lsh.copies(index).select("a", "b", F.lit("copy").alias("kind"), F.lit(1.0).alias("similarity")))


@query(
    "dup_components",
    f"""WITH RECURSIVE {LOW_SQL}, e AS (SELECT a, b FROM cand UNION SELECT b, a FROM cand), w(id, c) AS (SELECT a, a FROM e UNION SELECT e.b, w.c FROM w JOIN e ON e.a = w.id)
    SELECT id AS doc_id, min(c) AS component FROM w GROUP BY id""",
)
def dup_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lsh.build_index(_tokens(spark, sf_dir), LOW)
    linked = index.classes.join(lsh.grouped(index).withColumnRenamed("id", "rep"), "rep", "left").where("n > 1 OR component IS NOT NULL")
    linked = linked.select("rep", F.coalesce("component", "rep").alias("component"))
    return salted_join(index.members, linked, ["rep"], "id").where("component IS NOT NULL").select(F.col("id").alias("doc_id"), "component")


@query("dup_clusters")
def dup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.clusters(_tokens(spark, sf_dir), LOW)


@query("dup_clusters_nested")
def dup_clusters_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters with their members as structs, as the cluster file has them; a large one in parts of about 1,000 members."""
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("doc://"), "source", F.lit("/"), "doc_id").alias("url"))
    found = stored(lsh.clusters(_tokens(spark, sf_dir), LOW), "clusters")
    parts = found.groupBy("base").agg(F.ceil(F.count("*") / 1000).cast("int").alias("parts"))
    rows = salted_join(found, parts, ["base"], "id").join(docs, "id").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    member = F.struct(F.col("id").alias("base_index"), "url", F.lit(None).cast("string").alias("timestamp"), "is_extreme", "copies")
    return rows.groupBy("base", "part").agg(F.sort_array(F.collect_list(member)).alias("members"))


@query("near_dedup_075")
def near_dedup_075(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.near_dedup(_tokens(spark, sf_dir), load(spark, sf_dir, "documents"), LOW)


@query("near_dedup_085")
def near_dedup_085(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.near_dedup(_tokens(spark, sf_dir), load(spark, sf_dir, "documents"), HIGH)


@query("first_by_order", "SELECT page_id, url FROM (SELECT *, row_number() OVER (PARTITION BY html ORDER BY page_id) AS rn FROM pages) WHERE rn = 1")
def first_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First occurrence by content: the smallest id of each digest, an aggregate that combines map-side, and a semi-join."""
    pages = load(spark, sf_dir, "pages")
    content = F.struct(F.sha2("html", 256), F.octet_length("html"), F.col("html").isNull())
    first = pages.groupBy(content.alias("content")).agg(F.min("page_id").alias("page_id"))
    return pages.select("page_id", "url").join(first.select("page_id"), "page_id", "left_semi")
