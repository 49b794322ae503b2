"""Secret scans over an incremental blob ledger.

Every version of every document is addressed by the SHA-256 of its content. A ledger table in the shared folder holds,
for each blob and rule version scanned, the spans found (none included). A scan looks up which pairs of blob and rule
version are missing, reads only the blobs that lack some, appends their rows, and joins the findings back to every
path that holds the blob. DataFrame functions only.

A rule marks its matches with three private-use characters (text characters of that kind are first exchanged for
another of the same length, which no rule matches), so positions follow from the lengths between marks.

Defined cases: null texts are empty; texts without matches have counts of 0 and empty span lists; rows that repeat an id
are reported each; equal texts are scanned once; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

START, MIDDLE, END, OTHER = (chr(0xE000 + i) for i in range(4))


@dataclass(frozen=True)
class Rule:
    """Matches are head followed by tail; those with a tail (or, by `whole`, a match) shorter than `least` are dropped."""

    name: str
    head: str
    tail: str
    least: int
    whole: bool = False
    guard: tuple[str, ...] = ()  # substrings of which the lower-cased text has one if there is a match
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


_WORD = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))

#: The contract's kinds, in its order.
BASE_RULES = (
    Rule("assign", rf"(?:{_WORD})[\"']?\x20*[:=]\x20*[\"']?", r"[A-Za-z0-9+/_.=-]+", 6, guard=("password", "passwd", "secret", "token", "api_key", "apikey")),
    Rule("access", r"AKIA", r"[A-Z0-9]+", 20, whole=True, guard=("akia",)),
    # a run is taken whole, so runs of 24 and more are the runs with the short ones dropped
    Rule("hex", r"", r"[0-9a-f]{24,}", 24),
)
#: What the method adds.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN ", r"[A-Z ]*PRIVATE KEY-----", 16, guard=("private key-----",)),
    Rule("forge_token", r"gh[pousr]_", r"[A-Za-z0-9]+", 36, guard=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat_token", r"xox[abprs]-", r"[A-Za-z0-9-]+", 10, guard=("xox",)),
    Rule("web_token", r"eyJ", r"[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, guard=(".eyj",)),
)
RULES = BASE_RULES + MORE_RULES

SPANS = "array<struct<start:long,place:int,end:long,kind:string,rule:string>>"

PIECES = "array<struct<place:int,kind:string,rule:string,i:int,length:long,size:long,good:boolean>>"


def pieces(text: Column, lower: Column, rule: Rule, place: int) -> Column:
    """Lengths around a rule's marks: one entry for each piece of the text that a mark starts, the first at 0."""
    head = f"({rule.head})" if rule.head else "()"
    marked = F.regexp_replace(text, f"{head}({rule.tail})", f"{START}$1{MIDDLE}$2{END}")
    if rule.guard:
        marked = F.when(reduce(Column.__or__, map(lower.contains, rule.guard)), marked).otherwise(text)
    parts = F.split(marked, START)

    def measured(part: Column, i: Column) -> Column:
        match = F.substring_index(part, END, 1)
        tail = F.length(F.substring_index(match, MIDDLE, -1))
        size = F.when(i > 0, F.length(match) - 1).otherwise(0)
        used = size if rule.whole else tail
        return F.struct(
            F.lit(place).alias("place"),
            F.lit(rule.name).alias("kind"),
            F.lit(rule.key).alias("rule"),
            i.cast("int").alias("i"),
            (F.length(part) - F.when(i > 0, 2).otherwise(0)).cast("long").alias("length"),
            size.cast("long").alias("size"),
            ((i > 0) & (used >= rule.least)).alias("good"),
        )

    def all_measured(p: Column) -> Column:
        return F.when(F.size(p) > 1, F.transform(p, measured)).otherwise(F.array().cast(PIECES))

    return F.element_at(F.transform(F.array(parts), all_measured), 1)  # binds the parts: they are split once


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blobs: blob, text, pending (keys of the rules to run) -> blob, findings. Each blob once."""
    marks = F.col("text").contains(START) | F.col("text").contains(MIDDLE) | F.col("text").contains(END)
    clean = F.when(marks, F.translate("text", START + MIDDLE + END, OTHER * 3)).otherwise(F.col("text"))
    none = F.array().cast(PIECES)
    found = [F.when(F.array_contains("pending", r.key), pieces(F.col("clean"), F.col("lower"), r, n)).otherwise(none) for n, r in enumerate(rules)]
    rows = blobs.select("blob", clean.alias("clean"), F.lower("text").alias("lower"), "pending").select("blob", F.explode(F.concat(*found)).alias("p")).select("blob", "p.*")
    end = F.sum("length").over(common.window("blob", "place").orderBy("i"))
    rows = rows.withColumn("start", end - F.col("length")).where("good")
    span = F.struct("start", "place", (F.col("start") + F.col("size")).alias("end"), "kind", "rule")
    return rows.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("findings"))


def addressed(documents: DataFrame, text: str = "text") -> DataFrame:
    """documents with null texts made empty and the content address of each."""
    return documents.withColumn(text, F.coalesce(text, F.lit(""))).withColumn("blob", F.sha2(text, 256))


class BlobLedger:
    """The table of what has been scanned: blob, rules (keys), findings. A path keeps it from run to run."""

    schema = f"blob string, rules array<string>, findings {SPANS}"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{common.shared_root(spark)}/ledger/{uuid.uuid4().hex}"

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except Exception as e:  # no ledger yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], self.schema)

    def update(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scan what is unseen of versions (doc_id, blob, text); gives (doc_id, blob)."""
        paths = common.materialize(versions.select("doc_id", "blob"), "paths")
        current = F.array(*(F.lit(r.key) for r in rules))
        known = self.read().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        first = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
        pending = first.join(known, "blob", "left").select("blob", "doc_id", F.array_except(current, F.coalesce("seen", F.array().cast("array<string>"))).alias("pending"))
        pending = common.materialize(pending.where(F.size("pending") > 0), "pending")
        one = pending.toDF("__blob", "__id", "pending")
        unseen = versions.join(one, (F.col("blob") == F.col("__blob")) & F.col("doc_id").eqNullSafe(F.col("__id")))
        unseen = unseen.dropDuplicates(["blob"]) if self._repeats(paths) else unseen
        found = pending.join(scan(unseen.select("blob", "text", "pending"), rules), "blob", "left")
        rows = found.select("blob", F.col("pending").alias("rules"), F.coalesce("findings", F.array().cast(SPANS)).cast(SPANS).alias("findings"))
        rows.write.mode("append").parquet(self.path)
        return paths

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, findings) of the blobs in which these rules found something, spans by start, then rule order."""
        keys, names = (F.array(*map(F.lit, x)) for x in ([r.key for r in rules], [r.name for r in rules]))
        rows = self.read().where(F.arrays_overlap("rules", keys))
        merged = rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"))

        def now(x: Column) -> Column:
            return F.struct(x["start"].alias("start"), (F.array_position(names, x["kind"]) - 1).cast("int").alias("place"), x["end"].alias("end"), x["kind"].alias("kind"), x["rule"].alias("rule"))

        kept = F.transform(F.filter("findings", lambda x: F.array_contains(keys, x["rule"])), now)
        return merged.select("blob", F.sort_array(kept).alias("findings")).where(F.size("findings") > 0)

    @staticmethod
    def _repeats(paths: DataFrame) -> bool:
        """Whether a row of a document comes twice; then its blob must not be scanned twice."""
        return paths.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0


def find_secrets(documents: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: BlobLedger | None = None) -> DataFrame:
    """(doc_id, findings): spans by start, then rule order, for every row of documents."""
    ledger = ledger or BlobLedger(documents.sparkSession)
    paths = ledger.update(addressed(documents.select(F.col("doc_id").cast("long"), "text")), rules)
    found = common.salted_join(paths, ledger.findings(rules), ["blob"], "doc_id")  # a blob may be a third of all paths
    return found.select("doc_id", F.coalesce("findings", F.array().cast(SPANS)).alias("findings"))


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def redact(documents: DataFrame, mask: str = "[SECRET]", ledger: BlobLedger | None = None) -> DataFrame:
    """documents with the text of every finding replaced by `mask`; all columns and rows kept, null texts stay null."""
    ledger = ledger or BlobLedger(documents.sparkSession)
    ledger.update(addressed(documents.select(F.col("doc_id").cast("long"), "text")))
    first = F.struct(F.lit(0).cast("long").alias("from"), F.lit(0).cast("long").alias("reach"), F.array().cast("array<struct<from:long,to:long>>").alias("kept"))

    def keep(state: Column, span: Column) -> Column:
        """What lies between the findings so far and the next one; findings that overlap leave nothing between."""
        piece = F.struct(state["reach"].alias("from"), span["start"].alias("to"))
        kept = F.when(span["start"] >= state["reach"], F.array_append(state["kept"], piece)).otherwise(state["kept"])
        return F.struct(state["from"], F.greatest(state["reach"], span["end"]).alias("reach"), kept.alias("kept"))

    cuts = ledger.findings().select(F.col("blob").alias("__blob"), F.aggregate("findings", first, keep).alias("__cuts"))
    whole = common.salted_join(documents.withColumn("__blob", F.sha2(F.coalesce("text", F.lit("")), 256)), cuts, ["__blob"], "doc_id")
    pieces = F.transform("__cuts.kept", lambda p: F.substr("text", (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int")))
    tail = F.substr("text", (F.col("__cuts.reach") + 1).cast("int"))
    text = F.when(F.col("__cuts").isNotNull(), F.concat(F.array_join(pieces, mask), F.lit(mask), tail)).otherwise(F.col("text"))
    return whole.select(*(text.alias("text") if c == "text" else F.col(c) for c in documents.columns))


def op10_secret_ledger(spark: SparkSession, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """`ledger`: the path of a ledger that earlier runs filled; without one, a new ledger is begun."""
    found = find_secrets(common.table(spark, sf_dir, "documents"), ledger=BlobLedger(spark, ledger))
    base = [r.name for r in BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    digest = F.sha2(joined(F.filter("findings", lambda x: x["kind"].isin(*base))), 256)
    return found.select("doc_id", *map(count, base), digest.alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def _oracle() -> str:
    """The same findings in SQL: each rule's matches are marked, and the lengths before a mark add up to its place."""

    def found(n: int, r: Rule) -> str:
        head = f"({r.head})" if r.head else "()"
        pattern = f"{head}({r.tail})".replace("'", "''")
        piece = "string_split(substr(x.p, 1, length(x.p)), chr(57346))[1]"
        used = f"length({piece}) - 1" if r.whole else f"length(string_split({piece}, chr(57345))[2])"
        return f"""SELECT doc_id, {n} AS place, '{r.name}' AS kind, x.s AS s, x.s + length({piece}) - 1 AS e FROM (
          SELECT doc_id, unnest(list_transform(range(2, len(p) + 1), lambda i: {{'p': p[i], 's': CAST(list_sum(list_transform(p[1:i-1], lambda y: length(y))) AS BIGINT) - 2 * (i - 2)}})) AS x
          FROM (SELECT doc_id, string_split(regexp_replace(t, '{pattern}', chr(57344) || '\\1' || chr(57345) || '\\2' || chr(57346), 'g'), chr(57344)) AS p FROM d)) WHERE {used} >= {r.least}"""

    rows = " UNION ALL ".join(found(n, r) for n, r in enumerate(RULES))
    base = "kind IN ('assign', 'access', 'hex')"
    return f"""WITH d AS (SELECT doc_id, translate(coalesce(text, ''), chr(57344) || chr(57345) || chr(57346), chr(57347) || chr(57347) || chr(57347)) AS t FROM documents),
    f AS ({rows}), g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h,
      string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER ({base}) AS b, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS w FROM f GROUP BY doc_id)
    SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(w, '') AS spans FROM d LEFT JOIN g USING (doc_id)"""


OP10_SQL = _oracle()
