"""URL-domain analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats as s
from ..operators.tables import load
from .registry import query

NETLOC = "regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"
COUNTS = f"WITH d AS (SELECT *, {NETLOC} AS domain FROM pages), c AS (SELECT domain, count(*) AS n FROM d GROUP BY domain)"
TLDS = ("com", "id", "org")
DENIED = ("judi", "viagra", "obatkuat", "porno", "slot")
INCLUDED = ("ththre.example.com", "thther.example.org", "m.ththth.example.net")


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").withColumn("domain", s.netloc(F.col("url")))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domains(spark, sf_dir).groupBy("domain").agg(F.count("*").alias("n"))


@query("domain_counts", f"{COUNTS} SELECT domain, n FROM c")
def domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir)


@query("domain_topk", f"{COUNTS} SELECT domain, n FROM c ORDER BY n DESC, domain LIMIT 10")
def domain_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).orderBy(F.desc("n"), "domain").limit(10)


@query("domain_bottomk", f"{COUNTS} SELECT domain, n FROM c ORDER BY n, domain LIMIT 10")
def domain_bottomk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).orderBy("n", "domain").limit(10)


@query("domain_max", f"{COUNTS} SELECT domain, n FROM c ORDER BY n DESC, domain LIMIT 1")
def domain_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.min(F.struct((-F.col("n")).alias("less"), "domain", "n")).alias("x")
    return counts(spark, sf_dir).agg(best).select("x.domain", "x.n")


@query("domain_distinct", f"{COUNTS} SELECT count(*) AS domains, CAST(sum(n) AS BIGINT) AS urls FROM c")
def domain_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).agg(F.count("*").alias("domains"), F.sum("n").alias("urls"))


def tld_ok(c: Column) -> Column:
    """Last label among the allowed ones and no digit in the name."""
    return F.substring_index(c, ".", -1).isin(*TLDS) & ~c.rlike(r"\p{Nd}")


TLD_SQL = f"split_part(domain, '.', -1) IN {TLDS} AND NOT regexp_matches(domain, '[0-9]')"


@query("domain_tld_filter", f"{COUNTS} SELECT domain, n FROM c WHERE {TLD_SQL}")
def domain_tld_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).where(tld_ok(F.col("domain")))


@query("topk_then_filter", f"{COUNTS} SELECT * FROM (SELECT domain, n FROM c ORDER BY n DESC, domain LIMIT 20) WHERE {TLD_SQL}")
def topk_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).orderBy(F.desc("n"), "domain").limit(20).where(tld_ok(F.col("domain")))


@query("domain_denylist", f"{COUNTS} SELECT domain, n FROM c WHERE regexp_matches(domain, '{'|'.join(DENIED)}')")
def domain_denylist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).where(F.col("domain").rlike("|".join(DENIED)))


@query("domain_include", f"{COUNTS} SELECT page_id, domain FROM d WHERE domain IN {INCLUDED}")
def domain_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domains(spark, sf_dir).where(F.col("domain").isin(*INCLUDED)).select("page_id", "domain")


COMMON = "k AS (SELECT domain FROM c WHERE n >= 6)"


def common_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).where("n >= 6").select("domain")


@query("domain_semi", f"{COUNTS}, {COMMON} SELECT page_id, domain FROM d WHERE domain IN (SELECT domain FROM k)")
def domain_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domains(spark, sf_dir).join(common_domains(spark, sf_dir), "domain", "left_semi").select("page_id", "domain")


@query("domain_anti", f"{COUNTS}, {COMMON} SELECT page_id, domain FROM d WHERE domain NOT IN (SELECT domain FROM k)")
def domain_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domains(spark, sf_dir).join(common_domains(spark, sf_dir), "domain", "left_anti").select("page_id", "domain")


@query("domain_except", f"{COUNTS}, {COMMON} SELECT DISTINCT domain FROM d EXCEPT SELECT domain FROM k")
def domain_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domains(spark, sf_dir).select("domain").subtract(common_domains(spark, sf_dir))


@query("domain_sample_41", f"{COUNTS} SELECT page_id, url, domain FROM d WHERE domain LIKE '%.com' ORDER BY page_id LIMIT 41")
def domain_sample_41(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 41 rows of a domain in order: an early stop."""
    return domains(spark, sf_dir).where(F.col("domain").endswith(".com")).orderBy("page_id").limit(41).select("page_id", "url", "domain")


VALID = r"^https?://[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}(?::[0-9]{2,5})?(?:[/?#]\S*)?$"


@query("url_validity", f"SELECT page_id, regexp_matches(url, '{VALID}') AS valid FROM pages")
def url_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select("page_id", s.valid_url(F.col("url")).alias("valid"))


@query("domains_with_digit", f"{COUNTS} SELECT domain, regexp_matches(domain, '[0-9]') AS has_digit FROM c")
def domains_with_digit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).select("domain", F.col("domain").rlike(r"\p{Nd}").alias("has_digit"))
