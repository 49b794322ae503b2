"""Connected components of a links table, distributed: least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the least id reachable over links (a, b). Ids without a link have no row.

    Each round a node takes the least label among its own and its neighbours', then the label of its label; rounds are
    logarithmic on chains. State between rounds is a table in the shared folder.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both = materialize(both.distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), "labels")
    for _ in range(max_rounds):
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(near, "id", "left").select("id", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        jump = labels.select(F.col("id").alias("mid"), F.col("component").alias("far"))
        new = materialize(step.join(jump, "mid", "left").select("id", "old", F.least("mid", "far").alias("component")), "labels")
        changed = new.where("old <> component").limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
