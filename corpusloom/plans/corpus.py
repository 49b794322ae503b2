"""Ingestion, joins, set operations and the image-text union."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats as s
from ..operators.image_text import SourceSpec, UnionConfig, padded_id, record, url_column
from ..operators.tables import bounded, load, shared_path, stored, with_row_index, with_running_sum
from ..sources import sinks
from .registry import query


def normalised(df: DataFrame, text: str, set_name: str, url) -> DataFrame:
    return df.select(F.col(text).alias("text"), F.struct(F.lit(set_name).alias("set_name"), url.cast("string").alias("url")).alias("meta"))


@query(
    "normalise_union",
    """SELECT * FROM (SELECT text, 'documents' AS set_name, 'doc://' || source || '/' || doc_id AS url FROM documents UNION ALL SELECT html, 'pages', url FROM pages
    UNION ALL SELECT text, 'conversations', NULL FROM conversations UNION ALL SELECT text, 'benchmark', CAST(item_id AS VARCHAR) FROM benchmark) WHERE text <> ''""",
)
def normalise_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source as {text, meta: {set_name, url}}; empty texts are left out."""
    docs = normalised(load(spark, sf_dir, "documents"), "text", "documents", F.concat(F.lit("doc://"), "source", F.lit("/"), "doc_id"))
    rest = [
        normalised(load(spark, sf_dir, "pages"), "html", "pages", F.col("url")),
        normalised(load(spark, sf_dir, "conversations"), "text", "conversations", F.lit(None)),
        normalised(load(spark, sf_dir, "benchmark"), "text", "benchmark", F.col("item_id")),
    ]
    for other in rest:
        docs = docs.unionByName(other)
    return docs.where("text <> ''").select("text", "meta.set_name", "meta.url")


def union_config(spark: SparkSession, sf_dir: str, name: str = "all", flags: frozenset[str] = frozenset()) -> UnionConfig:
    """The driver tables as image-text sources; pages are the crawl that only has a training split, benchmark one behind a flag."""

    def part(df: DataFrame, key: str, split: str) -> DataFrame:
        return df.where(F.col(key) % 10 == 0 if split == "validation" else ~(F.col(key) % 10).eqNullSafe(0))

    def documents(split: str) -> DataFrame:
        df = part(load(spark, sf_dir, "documents"), "doc_id", split)
        path = F.concat(F.lit("images/"), padded_id(F.col("doc_id").cast("string")), F.lit(".jpg"))
        return record(df, "documents", "text", image=F.struct(path.alias("path"), F.lit(None).cast("binary").alias("bytes")), meta=("doc_id", "lang", "source"))

    def pages(split: str) -> DataFrame:
        df = load(spark, sf_dir, "pages")
        return record(df, "pages", "html", image_url=url_column(df, "image_url", "url"), meta=("page_id",))

    def conversations(split: str) -> DataFrame:
        return record(part(load(spark, sf_dir, "conversations"), "conv_id", split), "conversations", "text", meta=("conv_id", "turn", "role"))

    def benchmark(split: str) -> DataFrame:
        return record(load(spark, sf_dir, "benchmark"), "benchmark", "text", meta=("item_id",))

    specs = [SourceSpec("documents", documents), SourceSpec("pages", pages, splits=("train",)), SourceSpec("conversations", conversations)]
    specs.append(SourceSpec("benchmark", benchmark, splits=("train",), configs=(), flag="licensed"))
    return UnionConfig(name, specs, flags)


PAD = "CASE WHEN length(CAST(doc_id AS VARCHAR)) >= 12 THEN CAST(doc_id AS VARCHAR) ELSE lpad(CAST(doc_id AS VARCHAR), 12, '0') END"

SPLIT = "CASE WHEN {} % 10 = 0 THEN 'validation' ELSE 'train' END"


def both_splits(config: UnionConfig) -> DataFrame:
    train, validation = (config.table(split).withColumn("split", F.lit(split)) for split in ("train", "validation"))
    return train.unionByName(validation)


@query(
    "pmd_union",
    f"""SELECT NULL AS image_url, 'images/' || {PAD} || '.jpg' AS path, text, 'documents' AS source, {SPLIT.format("doc_id")} AS split FROM documents
    UNION ALL SELECT url, NULL, html, 'pages', 'train' FROM pages UNION ALL SELECT NULL, NULL, text, 'conversations', {SPLIT.format("conv_id")} FROM conversations""",
)
def pmd_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return both_splits(union_config(spark, sf_dir)).select("image_url", "image.path", "text", "source", "split")


@query(
    "pmd_union_validation",
    "SELECT source, count(*) AS n FROM (SELECT 'documents' AS source FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT 'conversations' FROM conversations WHERE conv_id % 10 = 0) GROUP BY source",
)
def pmd_union_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_config(spark, sf_dir).table("validation").groupBy("source").agg(F.count("*").alias("n"))


@query("pmd_meta_json", f"SELECT doc_id, lang, source AS set_source, {SPLIT.format('doc_id')} AS split FROM documents")
def pmd_meta_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON meta of a source, parsed again."""
    rows = both_splits(union_config(spark, sf_dir, "documents"))
    m = F.from_json("meta", "doc_id long, lang string, source string")
    return rows.select(m.alias("m"), "split").select("m.doc_id", "m.lang", F.col("m.source").alias("set_source"), "split")


@query("pmd_flagged_source", "SELECT text, 'benchmark' AS source, CAST(item_id AS VARCHAR) AS item FROM benchmark")
def pmd_flagged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that takes part under its own config and only with its flag."""
    rows = union_config(spark, sf_dir, "benchmark", frozenset({"licensed"})).table("train")
    return rows.select("text", "source", F.get_json_object("meta", "$.item_id").alias("item"))


@query("pmd_meta_dates", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def pmd_meta_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in the JSON meta are text."""
    rows = record(load(spark, sf_dir, "events"), "events", "event_type", meta=("event_id", "ts"))
    m = F.from_json("meta", "event_id long, ts string")
    return rows.select(m.alias("m")).select("m.event_id", F.substring("m.ts", 1, 19).alias("ts"))


@query("not_missing_filter", "SELECT event_id, value FROM events WHERE value IS NOT NULL AND NOT isnan(value)")
def not_missing_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").where(s.not_missing(F.col("value"))).select("event_id", "value")


@query("anti_invalid_ids", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def anti_invalid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    invalid = load(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return load(spark, sf_dir, "documents").join(invalid, "doc_id", "left_anti").select("doc_id", "source")


@query(
    "explode_captions",
    """WITH k AS (SELECT conv_id, list(struct_pack(turn := turn, text := text) ORDER BY turn) AS c FROM conversations WHERE role = 'user' GROUP BY conv_id)
    SELECT doc_id, x.turn AS turn, x.text AS caption, n_captions FROM (SELECT d.doc_id, len(c) AS n_captions, unnest(c) AS x FROM documents d JOIN k ON k.conv_id = d.doc_id)""",
)
def explode_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions collected per image id, joined to the images, one row per caption; images without captions are left out."""
    captions = load(spark, sf_dir, "conversations").where("role = 'user'").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("c"))
    rows = load(spark, sf_dir, "documents").select("doc_id").join(captions, "doc_id")
    return rows.select("doc_id", F.size("c").cast("long").alias("n_captions"), F.explode("c").alias("x")).select("doc_id", "x.turn", F.col("x.text").alias("caption"), "n_captions")


def numbered_lines(spark: SparkSession, sf_dir: str, places: DataFrame) -> DataFrame:
    """(file_id, line_no, line): the documents' lines, four text files by id, lines numbered in each file from 0."""
    rows = load(spark, sf_dir, "documents").select("doc_id", "text").join(places, "doc_id")
    rows = rows.select("file_id", "offset", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return rows.select("file_id", (F.col("offset") + F.col("at")).alias("line_no"), "line")


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, doc_id, offset, nb): where a document's lines are in its file."""
    docs = load(spark, sf_dir, "documents").select((F.col("doc_id") % 4).alias("file_id"), "doc_id", F.size(F.split("text", "\n")).cast("long").alias("nb"))
    rows = with_running_sum(docs, "nb", "file_id", "doc_id", name="before")
    first = rows.groupBy("file_id").agg(F.min("before").alias("first"))
    return rows.join(first, "file_id").select("file_id", "doc_id", "nb", (F.col("before") - F.col("first")).alias("offset"))


@query(
    "offset_slice_join",
    """WITH l AS (SELECT doc_id % 4 AS file_id, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
    n AS (SELECT file_id, line, row_number() OVER (PARTITION BY file_id ORDER BY doc_id, i) - 1 AS line_no FROM l),
    o AS (SELECT doc_id % 4 AS file_id, doc_id, len(string_split(text, chr(10))) AS nb FROM documents),
    p AS (SELECT *, coalesce(sum(nb) OVER (PARTITION BY file_id ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM o)
    SELECT p.doc_id, string_agg(line, '' ORDER BY line_no) AS text FROM p JOIN n ON n.file_id = p.file_id AND line_no >= off AND line_no < off + nb GROUP BY p.doc_id""",
)
def offset_slice_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts put together from line files and (offset, count) records: the interval join as an equi-join on line numbers."""
    places = stored(offsets(spark, sf_dir), "offsets")
    n = places.agg(F.sum("nb")).first()[0] or 0  # lines; a task gets about as many however many there are
    wanted = places.select("file_id", "doc_id", F.explode(F.sequence("offset", F.col("offset") + F.col("nb") - 1)).alias("line_no"))
    keys = ["file_id", "line_no"]
    rows = bounded(wanted, n, *keys).join(bounded(numbered_lines(spark, sf_dir, places), n, *keys), keys)
    lines = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return bounded(rows, n, "doc_id").groupBy("doc_id").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "").alias("text"))


@query(
    "positional_zip",
    "WITH a AS (SELECT page_id, row_number() OVER (ORDER BY url, page_id) AS n FROM pages), b AS (SELECT item_id, row_number() OVER (ORDER BY text, item_id) AS n FROM benchmark) SELECT page_id, item_id FROM a JOIN b USING (n)",
)
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sorted lists joined by position."""
    left = with_row_index(load(spark, sf_dir, "pages").select("page_id", "url"), "url", "page_id")
    right = with_row_index(load(spark, sf_dir, "benchmark"), "text", "item_id")
    return left.join(right, "row_index").select("page_id", "item_id")


TOPICS = ("news", "sport", "tech")


@query("date_topic_grid", "SELECT strftime(d, '%Y-%m-%d') AS day, topic FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS d), (SELECT unnest(['news', 'sport', 'tech']) AS topic)")
def date_topic_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days by topics: both lists are fixed by the arguments, so the product is."""
    dates = F.sequence(F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-01-31")))
    days = spark.range(1).select(F.explode(F.transform(dates, lambda d: F.date_format(d, "yyyy-MM-dd"))).alias("day"))
    return days.select("day", F.explode(F.array(*map(F.lit, TOPICS))).alias("topic"))


ARTICLE = "'https://site.example/read/2024/01/' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '/' || (doc_id % 97) || '/title-' || doc_id"


@query(
    "article_id_dedup",
    rf"""WITH a AS (SELECT doc_id, {ARTICLE} AS url, doc_id % 28 + 1 AS day FROM documents), i AS (SELECT *, regexp_replace(url, '.+/read/\d+/\d+/\d+/(\d+).+', '\1') AS article FROM a)
    SELECT day, article, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY day, article ORDER BY doc_id) AS rn FROM i) WHERE rn = 1""",
)
def article_id_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first article of each day and article number."""
    docs = load(spark, sf_dir, "documents")
    day = (F.col("doc_id") % 28 + 1).alias("day")
    url = F.concat(F.lit("https://site.example/read/2024/01/"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit("/"), F.col("doc_id") % 97, F.lit("/title-"), "doc_id")
    return docs.select(day, s.article_id(url).alias("article"), "doc_id").groupBy("day", "article").agg(F.min("doc_id").alias("doc_id"))


LINK = '<a href="([^"]*)">([^<]*)</a>'


@query("html_links", f"SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 1)) AS href, unnest(regexp_extract_all(html, '{LINK}', 2)) AS label FROM pages")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(LINK), F.lit(2)).alias("label"))
    return load(spark, sf_dir, "pages").select("page_id", F.inline(pairs).alias("href", "label"))


LICENCES = {"src0": "CC-BY-4.0", "src1": "CC0-1.0", "src2": "MIT", "src3": "unknown"}


@query("licence_lookup", "SELECT doc_id, CASE source WHEN 'src0' THEN 'CC-BY-4.0' WHEN 'src1' THEN 'CC0-1.0' WHEN 'src2' THEN 'MIT' WHEN 'src3' THEN 'unknown' END AS licence FROM documents")
def licence_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = F.create_map(*(F.lit(x) for pair in LICENCES.items() for x in pair))
    return load(spark, sf_dir, "documents").select("doc_id", F.try_element_at(table, F.col("source")).alias("licence"))


@query(
    "field_helpers",
    f"""SELECT doc_id, {PAD} AS padded, 'https://img.example/' || doc_id || '_z.jpg' AS image_url, CASE WHEN contains(text, ' ') THEN substr(text, instr(text, ' ') + 1) ELSE '' END AS rest,
    string_split(text, ' ')[1] AS first_word, regexp_extract('/data/' || source || '/part.json.gz', '([^/.]+)[^/]*$', 1) AS stem, '.' || split_part('/data/' || source || '/part.json.gz', '.', -1) AS extension FROM documents""",
)
def field_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded ids, URLs from ids, a line without its first token, first element, file stem and extension."""
    path, text = F.concat(F.lit("/data/"), "source", F.lit("/part.json.gz")), F.col("text")
    space = F.instr(text, " ")
    return load(spark, sf_dir, "documents").select(
        "doc_id",
        padded_id(F.col("doc_id").cast("string")).alias("padded"),
        F.concat(F.lit("https://img.example/"), "doc_id", F.lit("_z.jpg")).alias("image_url"),
        F.when(space > 0, F.substr(text, space + 1)).otherwise("").alias("rest"),
        F.try_element_at(F.split(text, " "), F.lit(1)).alias("first_word"),
        F.regexp_extract(path, "([^/.]+)[^/]*$", 1).alias("stem"),
        F.concat(F.lit("."), F.substring_index(path, ".", -1)).alias("extension"),
    )


@query("null_audit", "SELECT 'documents' AS name, count(*) AS n, count(*) FILTER (text IS NULL) AS null_text, count(*) FILTER (lang IS NULL) AS null_lang, bool_or(text IS NULL OR lang IS NULL) AS any_null FROM documents")
def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = [F.col(c).isNull() for c in ("text", "lang")]
    return load(spark, sf_dir, "documents").agg(
        F.lit("documents").alias("name"), F.count("*").alias("n"), F.count_if(missing[0]).alias("null_text"), F.count_if(missing[1]).alias("null_lang"), F.bool_or(missing[0] | missing[1]).alias("any_null")
    )


@query("lang_filter", "SELECT doc_id, lang FROM documents WHERE text IS NOT NULL AND lang = 'de'")
def lang_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").where("text IS NOT NULL AND lang = 'de'").select("doc_id", "lang")


@query("positional_slice", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 50 OFFSET 100")
def positional_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").orderBy("doc_id").offset(100).limit(50).select("doc_id", "n_chars")


@query("shuffled_sample", "SELECT doc_id, md5('7|' || doc_id) AS place FROM documents ORDER BY md5('7|' || doc_id) LIMIT 3")
def shuffled_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rows of a shuffle that is the same on every run."""
    place = F.md5(F.concat(F.lit("7|"), "doc_id"))
    return load(spark, sf_dir, "documents").select("doc_id", place.alias("place")).orderBy("place").limit(3)


@query("global_shuffle", "SELECT doc_id, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) - 1 AS place FROM documents")
def global_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").select("doc_id", F.md5(F.concat(F.lit("7|"), "doc_id")).alias("h"))
    return with_row_index(rows, "h", "doc_id", name="place").select("doc_id", "place")


@query("set_equality", "SELECT NOT EXISTS (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents) AS covered, NOT EXISTS (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) AS equal")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether two lists hold the same entries, by counts of what either lacks."""
    docs, labels = (load(spark, sf_dir, t).select("doc_id").distinct() for t in ("documents", "labels"))
    lack = labels.join(docs, "doc_id", "left_anti").agg((F.count("*") == 0).alias("covered"))
    more = docs.join(labels, "doc_id", "left_anti").agg((F.count("*") == 0).alias("equal"))
    return lack.join(more)


@query("metrics_row", "SELECT count(*) AS rows, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents")
def metrics_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts written as a one-row metrics file, and read again."""
    sinks.write_metrics(load(spark, sf_dir, "documents").agg(F.count("*").alias("rows"), F.sum("n_chars").alias("chars")), path := shared_path(spark, "metrics"))
    return spark.read.schema("rows long, chars long").json(path)
