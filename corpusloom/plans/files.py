"""Files written and read again, and incremental ingestion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import stats as s
from ..operators.tables import load, shared_path, stored
from ..sources import crawl, readers, sinks
from ..streaming import ingest
from .registry import query

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SAME = "SELECT doc_id, text, lang, source, n_chars FROM documents"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")


def _half() -> Column:
    """0 or 1 for every id, null and below 0 too."""
    return F.coalesce(F.pmod("doc_id", F.lit(2)), F.lit(0))


@query("csv_roundtrip", SAME)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks.write_csv(_docs(spark, sf_dir), path := shared_path(spark, "csv"))
    return readers.read_csv(spark, path, SCHEMA, line_end="\n")


@query("tsv_roundtrip", "SELECT doc_id, replace(replace(text, chr(10), ' '), chr(9), ' ') AS text, lang FROM documents")
def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written in two batches that append."""
    flat = F.translate("text", "\n\t", "  ").alias("text")
    path, docs = shared_path(spark, "tsv"), _docs(spark, sf_dir).select("doc_id", flat, "lang")
    for half in (0, 1):
        sinks.write_tsv(docs.where(_half() == half), path)
    return readers.read_tsv(spark, path, "doc_id long, text string, lang string", line_end="\n")


@query("jsonl_roundtrip", SAME)
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain JSON lines, written in two batches that append."""
    path, docs = shared_path(spark, "jsonl"), _docs(spark, sf_dir)
    for half in (0, 1):
        sinks.write_jsonl(docs.where(_half() == half), path, mode="append")
    return readers.read_jsonl(spark, path, SCHEMA)


@query("jsonl_bz2_roundtrip", SAME)
def jsonl_bz2_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks.write_jsonl(_docs(spark, sf_dir), path := shared_path(spark, "jsonl-bz2"), compression="bzip2")
    return readers.read_jsonl(spark, path, SCHEMA)


@query("sharded_jsonl_gz", "SELECT lpad(CAST((row_number() OVER (ORDER BY doc_id) - 1) // 300 + 1 AS VARCHAR), 12, '0') AS shard, doc_id, text FROM documents")
def sharded_jsonl_gz(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks.write_shards(_docs(spark, sf_dir), path := shared_path(spark, "shards"), "doc_id", 300)
    rows = readers.read_jsonl(spark, f"{path}/*", "doc_id long, text string")
    return rows.select(F.regexp_extract("_metadata.file_path", "shard=([0-9]+)", 1).alias("shard"), "doc_id", "text")


@query("parquet_split", "SELECT doc_id, lang FROM documents WHERE lang = 'de'")
def parquet_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split is a partition folder: reading one reads no other."""
    path = shared_path(spark, "splits")
    _docs(spark, sf_dir).withColumn("split", F.col("lang")).write.partitionBy("split").parquet(path)
    return readers.read_split(spark, path, "de").select("doc_id", "lang")


@query("text_lines", "SELECT count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM (SELECT unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line FROM documents)")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "text")
    _docs(spark, sf_dir).select(F.replace("text", F.lit("\r"), F.lit("")).alias("value")).write.text(path)
    return readers.read_lines(spark, path).agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


@query("file_line_counts", "SELECT lang, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS lines FROM documents GROUP BY lang")
def file_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "by-lang")
    _docs(spark, sf_dir).select("lang", F.col("text").alias("value")).write.partitionBy("lang").text(path)
    counts = readers.count_lines(spark, f"{path}/*")
    return counts.groupBy(F.regexp_extract("file", "lang=([a-z]+)", 1).alias("lang")).agg(F.sum("lines").alias("lines"))


@query("nested_json_document", "SELECT conv_id AS doc_id, turn, role FROM conversations")
def nested_json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows gathered into whole-file documents of an array each, indented over many lines, and taken apart again."""
    rows = load(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", "role")
    sinks.write_json_documents(rows, path := shared_path(spark, "nested"), "images")
    return readers.read_json_document(spark, f"{path}/*", "images array<struct<doc_id:long,turn:long,role:string>>", "images")


@query("tsv_gz_column", "SELECT source AS value, count(*) AS n FROM documents GROUP BY source")
def tsv_gz_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third column of gzip TSV files, by position."""
    sinks.write_tsv(_docs(spark, sf_dir).select("doc_id", "lang", "source", "n_chars"), path := shared_path(spark, "tsv-gz"), compression="gzip")
    return readers.read_tsv_column(spark, path, 2, line_end="\n").groupBy("value").agg(F.count("*").alias("n"))


@query("literal_lines", "SELECT doc_id, lang, source FROM documents")
def literal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that hold Python dicts."""
    line = F.concat(F.lit("{'doc_id': "), "doc_id", F.lit(", 'lang': '"), "lang", F.lit("', 'source': \""), "source", F.lit('"}'))
    _docs(spark, sf_dir).select(line.alias("value")).write.text(path := shared_path(spark, "literals"))
    return readers.parse_literals(readers.read_lines(spark, path), StructType.fromDDL("doc_id long, lang string, source string"))


@query("conllu_metadata", "SELECT doc_id, lang FROM documents")
def conllu_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences' metadata of CoNLL-U files."""
    sentence = F.concat(F.lit("# sent_id = "), "doc_id", F.lit("\n# lang = "), "lang", F.lit("\n1\tword\t_\n"))
    _docs(spark, sf_dir).select(sentence.alias("value")).write.text(path := shared_path(spark, "conllu"))
    meta = readers.read_conllu(spark, path)
    return meta.select(F.col("metadata.sent_id").cast("long").alias("doc_id"), F.col("metadata.lang").alias("lang"))


@query("file_discovery", "SELECT lang, 1 AS files FROM (SELECT DISTINCT lang FROM documents)")
def file_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text files below a folder, by the folder that they are in."""
    path = shared_path(spark, "tree")
    _docs(spark, sf_dir).select("lang", F.lit("x").alias("value")).distinct().repartition("lang").write.partitionBy("lang").text(path)
    found = readers.list_files(spark, path, "*.txt")
    return found.groupBy(F.regexp_extract("path", "lang=([a-z]+)", 1).alias("lang")).agg(F.count("*").cast("int").alias("files"))


@query("keyed_upsert", "SELECT doc_id % 50 AS k, max(doc_id // 50) AS round FROM documents GROUP BY 1")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that arrive one after another into a keyed store; the last row of a key counts."""
    root = shared_path(spark, "upsert")
    rounds = F.floor(F.col("doc_id") / 50)
    rows = _docs(spark, sf_dir).groupBy((F.col("doc_id") % 50).alias("k")).agg(F.array(F.min(rounds), F.max(rounds)).alias("rounds"))
    rows = rows.select("k", F.posexplode("rounds").alias("step", "round"))
    for step in (0, 1):
        rows.where(F.col("step") == step).select("k", "round").coalesce(1).write.mode("append").parquet(f"{root}/in{step}")
        ingest.upsert_each(ingest.incoming(spark, f"{root}/in{step}", "k long, round long"), lambda b, n, at=step: sinks.upsert_into(f"{root}/store")(b, 1000 * at + n), f"{root}/state{step}")
    return readers.read_latest(spark, f"{root}/store", "k long, round long", "k")


@query("config_checked_scan", "SELECT doc_id, lang FROM documents")
def config_checked_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files named by a configuration that checks their kinds."""
    sinks.write_jsonl(_docs(spark, sf_dir).select("doc_id", "lang"), path := f"{shared_path(spark, 'config')}.json")
    return readers.InputConfig(train=path).read(spark, "train", "doc_id long, lang string")


@query("escaped_csv_lines", """SELECT item_id, '"' || item_id || '","' || replace(text, '"', '\\"') || '"' AS line FROM benchmark""")
def escaped_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "benchmark").select("item_id", sinks.escaped_csv_line("item_id", "text").alias("line"))


@query(
    "sql_dump_scan",
    r"""WITH l AS (SELECT doc_id AS line_no, CASE WHEN doc_id % 3 = 0 THEN 'INSERT INTO docs VALUES (' || doc_id || ',' || lang || '),(' || n_chars || ',' || source || ');' ELSE '-- note' END AS line FROM documents)
    SELECT line_no, string_split(t, ',')[1] AS first, string_split(t, ',')[2] AS second FROM (SELECT line_no, unnest(regexp_extract_all(line, '\((.*?)\)', 1)) AS t FROM (SELECT * FROM l WHERE starts_with(line, 'INSERT INTO') ORDER BY line_no LIMIT 50))""",
)
def sql_dump_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuples of the first 50 INSERT lines of a dump."""
    insert = F.concat(F.lit("INSERT INTO docs VALUES ("), "doc_id", F.lit(","), "lang", F.lit("),("), "n_chars", F.lit(","), "source", F.lit(");"))
    lines = _docs(spark, sf_dir).select(F.col("doc_id").alias("line_no"), F.when(F.col("doc_id") % 3 == 0, insert).otherwise("-- note").alias("line"))
    return readers.sql_tuples(lines, 50).select("line_no", F.get("values", F.lit(0)).alias("first"), F.get("values", F.lit(1)).alias("second"))


# Shards of each size by split, and the shards that there are.
SHARDS = {
    "tiny": {"train": 100, "validation": 1},
    "small": {"train": 250, "validation": 2},
    "medium": {"train": 500, "validation": 4},
    "large": {"train": 750, "validation": 6},
    "full": {"train": 1016, "validation": 8},
}
TOTAL = {"train": 1024, "validation": 8}
SHARD_URL = "https://data.example/corpus%s.part-%05d-of-%05d.json.gz"
_SHARD_SQL = " UNION ALL ".join(
    f"SELECT '{size}' AS size, '{split}' AS split, 'https://data.example/corpus{'' if split == 'train' else '-validation'}.part-' || lpad(CAST(range AS VARCHAR), 5, '0') || '-of-{TOTAL[split]:05d}.json.gz' AS url FROM range({n})"
    for size, splits in SHARDS.items()
    for split, n in splits.items()
)


@query("shard_urls", _SHARD_SQL)
def shard_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every size's shards of both splits."""
    parts = [readers.shard_urls(spark, SHARD_URL, split, n, TOTAL[split]).withColumn("size", F.lit(size)) for size, splits in SHARDS.items() for split, n in splits.items()]
    return reduce(DataFrame.unionByName, parts).select("size", "split", "url")


@query("crawl_paging", "SELECT source, doc_id % 3 AS page, 'https://news.example/read/' || doc_id AS link FROM documents WHERE doc_id % 3 IN (0, 1, 2)")
def crawl_paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings followed from page to page; sources stand for topics, with three pages of links each."""
    page = (F.col("doc_id") % 3).alias("page")
    anchor = F.concat(F.lit('<h3><a class="article__link" href="https://news.example/read/'), "doc_id", F.lit('">x</a></h3>'))
    listed = _docs(spark, sf_dir).groupBy("source", page).agg(F.array_join(F.collect_list(anchor), "").alias("links"))

    def address(n: Column) -> Column:
        return F.concat(F.lit("https://news.example/"), "source", F.lit("?page="), n)

    following = F.when(F.col("page") < 2, F.concat(F.lit('<a class="paging__link paging__link--next" href="'), address(F.col("page") + 1), F.lit('">Next</a>'))).otherwise("")
    pages = stored(listed.select(address(F.col("page")).alias("url"), F.concat("links", following).alias("html")), "pages")
    seeds = _docs(spark, sf_dir).select("source").distinct().select("source", address(F.lit(0)).alias("url"))
    return crawl.follow(seeds, pages).select("source", F.col("round").cast("long").alias("page"), "link")


DISTINCT = r"SELECT DISTINCT md5(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS hash FROM documents"


def _arriving(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Documents' files that come one after another, as a stream; a batch takes a file for each core, so no task has more than a file."""
    ingest.arrivals(_docs(spark, sf_dir), 3, "doc_id", f"{root}/in", files=None)
    return ingest.incoming(spark, f"{root}/in", SCHEMA, files_per_batch=spark.sparkContext.defaultParallelism)


@query("stream_ingest_dedup", DISTINCT)
def stream_ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that come one after another; contents not seen before are appended."""
    root = shared_path(spark, "stream-dedup")
    hashes = _arriving(spark, sf_dir, root).select(s.content_hash(F.col("text")).alias("hash"))  # texts aren't shuffled
    ingest.append_to(ingest.first_seen(hashes, F.col("hash")), f"{root}/out", f"{root}/state")
    return spark.read.schema("hash string").parquet(f"{root}/out")


@query("stream_batches", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arriving files are processed in batches with a number each."""
    root = shared_path(spark, "stream-batches")
    ingest.process_new(_arriving(spark, sf_dir, root), lambda b: b.groupBy("lang").agg(F.count("*").alias("n")), f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out").groupBy("lang").agg(F.sum("n").alias("n"))
