"""Mixing sources to target weights by entropy balancing, DataFrame functions only.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating, and share all words; a target stops at
`most` times its source's size and the excess is reshared by weight until none is above.

Rates: for each source the rates w of its documents minimise sum(w log w - w + 1) under sum(size * w) = target and
0 <= w <= most. The dual has one variable per source; its optimum tilts exponentially, w = min(most, exp(l * size / s)),
s being the source's words-weighted mean size. Newton steps on all duals at once, kept inside a bracket, aggregate over
the table of (source, size, number of documents), which is small beside the corpus and has no texts.

Rounding: the copies of all documents of one size are rounded cumulatively from the largest size to the smallest, so the
words taken stay near the target at every step; what is left is added to or taken from the smallest documents, again
cumulatively. Sums of the dual are exact decimals, so no order of a shuffle can move a copy. The copies of a size are dealt to its documents in the order of a hash of doc_id, counted in two levels
(hash ranges, then places inside a range), so no size or source is gathered in one task.

Defined cases: null or empty texts have size 0 and take 0; null sources are one source, after all others; a source
without words has target 0; rows that repeat an id count each, as do rows without one; very long texts count whole, and
tied sizes share their copies in the order of the hashes; an empty table gives no rows; other columns are ignored.
Reruns agree: only hashes of ids decide.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[float, ...] = (1.0, 2.0, 3.0)
    most: int = 3
    newton_steps: int = 24
    tolerance: float = 1e-9
    ranges: int = 1024


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sizes(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), "source", word_count("text").alias("size"))


def targets(sources: DataFrame, config: MixConfig) -> DataFrame:
    """sources: source, source_size -> with target. A window over the table of sources, not over documents: a few dozen
    bytes for each, so that millions of sources fit the one task.

    Resharing settles in one pass: weights w and caps most * size mean a target of min(cap, w * level) with one level for
    all, and sources fill up in the order of cap / w; the level follows from running sums in that order.
    """
    w = F.element_at(F.array(*map(F.lit, config.weights)), (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(config.weights))) + 1).cast("int"))
    cap = F.col("source_size").cast("double") * config.most
    rows = sources.withColumn("weight", w).withColumn("cap", cap).withColumn("fill", F.col("cap") / F.col("weight"))
    order = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everyone = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(everyone)
    open_weight = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / open_weight
    # the first source in this order whose cap is above its share sets the level of all that follow
    rows = rows.withColumns({"level": level, "at": F.row_number().over(order)})
    level = F.min_by("level", F.when(F.col("fill") >= F.col("level"), F.col("at"))).over(everyone)
    return rows.withColumn("target", F.least(F.col("cap"), F.col("weight") * F.coalesce(level, F.lit(0.0)))).select("source", "source_size", "target")


def tilted(dual: Column, config: MixConfig) -> Column:
    return F.least(F.lit(float(config.most)), F.exp(F.least(dual * F.col("z"), F.lit(50.0))))


def solve(table: DataFrame, config: MixConfig) -> DataFrame:
    """table: sid, size, n, z, target -> sid, dual. Newton steps inside a bracket, all sources at once."""
    spark = table.sparkSession
    duals = table.groupBy("sid").agg(F.max("target").alias("target"), F.max(F.col("source_size").cast("double")).alias("total"), F.min(F.when(F.col("z") > 0, F.col("z"))).alias("zmin"))
    high = F.log(F.lit(float(config.most))) / F.coalesce("zmin", F.lit(1.0))
    duals = duals.select("sid", "target", "total", F.lit(0.0).alias("dual"), (-F.lit(60.0) * F.greatest(F.lit(1.0), high)).alias("low"), high.alias("high"))
    duals = common.materialize(duals, "duals")

    def total(c: Column) -> Column:
        return F.sum(c.cast("decimal(38,12)")).cast("double")

    for _ in range(config.newton_steps):
        w = tilted(F.col("dual"), config)
        sums = (
            table.select("sid", "size", "n", "z")
            .join(duals.select("sid", "dual"), "sid")
            .groupBy("sid")
            .agg(total(F.col("n") * F.col("size") * w).alias("value"), total(F.when(w < config.most, F.col("n") * F.col("size") * F.col("z") * w).otherwise(0.0)).alias("slope"))
        )
        step = duals.join(sums, "sid")
        miss = F.col("value") - F.col("target")
        low, up = F.when(miss < 0, F.col("dual")).otherwise(F.col("low")), F.when(miss > 0, F.col("dual")).otherwise(F.col("high"))
        step = step.withColumns({"low": low, "high": up, "miss": miss})
        newton = F.col("dual") - F.try_divide("miss", "slope")
        middle = (F.col("low") + F.col("high")) / 2
        inside = newton.isNotNull() & (newton > F.col("low")) & (newton < F.col("high"))
        done = F.abs("miss") <= F.lit(config.tolerance) * F.greatest(F.col("total"), F.lit(1.0))
        step = step.withColumn("next", F.when(done, F.col("dual")).when(inside, newton).otherwise(middle))
        step = common.materialize(step.select("sid", "target", "total", F.col("next").alias("dual"), "low", "high", done.alias("done")), "duals")
        duals = step.drop("done")
        if not step.where("NOT done").limit(1).count():
            break
    return duals.select("sid", "dual")


def copies_by_size(table: DataFrame, config: MixConfig) -> DataFrame:
    """table: sid, size, n, rate, target -> sid, size, n, copies: whole copies of all documents of a size together."""
    ideal = F.col("n") * F.col("rate")
    down = Window.partitionBy("sid").orderBy(F.col("size").desc())
    run = F.sum(ideal).over(down)
    start = F.lag(run_floor := F.floor(F.col("run") + 0.5), 1, 0).over(down)
    rows = table.withColumn("run", run).withColumn("copies", run_floor - start).drop("run")
    rows = rows.withColumn("copies", F.least(F.col("copies"), F.col("n") * config.most))
    left = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(Window.partitionBy("sid"))
    rows = rows.withColumn("left", left)
    # from the smallest documents up, add (or take) one copy each as long as words are left; the last size in part
    room = F.when(F.col("size") == 0, F.lit(0)).when(F.col("left") >= 0, F.least(F.col("n"), F.col("n") * config.most - F.col("copies"))).otherwise(F.least(F.col("n"), F.col("copies")))
    rows = rows.withColumn("room", room)
    used = F.sum(F.col("room") * F.col("size")).over(Window.partitionBy("sid").orderBy("size").rowsBetween(Window.unboundedPreceding, -1))
    free = F.greatest(F.abs("left") - F.coalesce(used, F.lit(0)), F.lit(0.0))
    change = F.least(F.col("room"), F.floor(F.try_divide(free, F.col("size").cast("double")) + 0.5))
    change = F.coalesce(change, F.lit(0)) * F.signum("left").cast("long")
    return rows.select("sid", "size", "n", (F.col("copies") + change).cast("long").alias("copies"))


def mix(documents: DataFrame, config: MixConfig | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken."""
    config = config or MixConfig()
    docs = common.materialize(sizes(documents), "sizes")
    table = docs.groupBy("source", "size").agg(F.count("*").alias("n"))
    table = common.materialize(table, "size-table")
    total = F.sum(F.col("n") * F.col("size")).cast("long")
    sources = table.groupBy("source").agg(total.alias("source_size"), F.try_divide(F.sum(F.col("n") * F.col("size") * F.col("size")).cast("double"), total).alias("scale"))
    # one id per source, so that joins treat the null source as any other
    named = targets(sources.select("source", "source_size"), config).withColumn("sid", F.xxhash64(F.col("source").isNull(), "source"))
    named = common.materialize(named.join(sources.select(F.xxhash64(F.col("source").isNull(), "source").alias("sid"), "scale"), "sid"), "targets")
    table = table.withColumn("sid", F.xxhash64(F.col("source").isNull(), "source")).drop("source").join(named.drop("source"), "sid")
    table = common.materialize(table.withColumn("z", F.coalesce(F.try_divide(F.col("size").cast("double"), F.col("scale")), F.lit(0.0))), "dual-table")
    rates = table.join(solve(table, config), "sid").withColumn("rate", tilted(F.col("dual"), config))
    plan = common.materialize(copies_by_size(rates, config).join(rates.select("sid", "size", "source_size", "target", "rate"), ["sid", "size"]), "copies")
    place = F.xxhash64("doc_id", F.lit(11))
    docs = docs.withColumns({"sid": F.xxhash64(F.col("source").isNull(), "source"), "h": place, "range": F.pmod(F.shiftrightunsigned(place, 20), F.lit(config.ranges))})
    counts = docs.groupBy("sid", "size", "range").agg(F.count("*").alias("m"))
    earlier = Window.partitionBy("sid", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("sid", "size", "range", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("sid", "size", "range").orderBy("h", "doc_id"))
    ranked = docs.withColumn("rank", rank).join(counts, ["sid", "size", "range"]).withColumn("rank", F.col("rank") + F.col("before"))
    full = ranked.join(plan, ["sid", "size"])
    each = F.floor(F.col("copies") / F.col("n"))
    copies = (each + F.when(F.col("rank") <= F.col("copies") - each * F.col("n"), 1).otherwise(0)).cast("long")
    return full.select("doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def attach(documents: DataFrame, config: MixConfig | None = None, clash: str = "mix_") -> DataFrame:
    """documents with size, source_size, target, rate, copies and taken; a name that is there already gets `clash`.

    Each row gets counts of its own: rows that share id, source and size, as those without an id, are numbered by text.
    """
    mixed = mix(documents.select("doc_id", "source", "text"), config)
    added = {c: f"{clash}{c}" if c in documents.columns else c for c in mixed.columns if c not in ("doc_id", "source")}
    keys = {"__id": F.col("doc_id").cast("long"), "__source": F.col("source"), "__size": F.col("size")}
    left = documents.withColumns(keys | {"__size": word_count("text")})
    right = mixed.withColumns(keys)
    if mixed.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count():
        same = Window.partitionBy("__id", "__source", "__size")
        left = left.withColumn("__at", F.row_number().over(same.orderBy(F.sha2("text", 256))))
        right = right.withColumn("__at", F.row_number().over(same.orderBy(F.desc("copies"))))
    else:
        left, right = left.withColumn("__at", F.lit(1)), right.withColumn("__at", F.lit(1))
    names = ["__id", "__source", "__size", "__at"]
    right = right.select(*(F.col(k).alias(f"{k}r") for k in names), *(F.col(c).alias(f"__new_{c}") for c in added))
    on = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"{k}r")) for k in names))
    return left.join(right, on, "left").select(*documents.columns, *(F.col(f"__new_{c}").alias(to) for c, to in added.items()))


def op5_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")
