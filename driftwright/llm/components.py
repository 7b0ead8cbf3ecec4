"""Connected components of a link table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stash, stash


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of the links; a component is named by its smallest node.

    Each round takes the least label among a node's neighbours, then the label of that label; it ends when no
    label changes. Labels are aggregated before they are shuffled by node, so a hub sends one row per task.
    Links with a null end are ignored; self links and repeated links change nothing.
    """
    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("x"), F.col(b).alias("y"))
    links = stash(known.union(known.select(F.col("y"), F.col("x"))).distinct())
    labels = stash(links.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("component")))
    while True:
        near = links.join(labels.select(F.col("node").alias("y"), "component"), "y").groupBy(F.col("x").alias("node")).agg(F.min("component").alias("near"))
        least = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("least"))
        least = stash(least)
        jumped = least.join(least.select(F.col("node").alias("least"), F.col("least").alias("next")), "least").select("node", F.col("next").alias("component"), F.col("component").alias("before"))
        following = stash(jumped)
        changed = not following.where("component <> before").isEmpty()
        drop_stash(labels)
        drop_stash(least)
        labels = following
        if not changed:
            return labels.select("node", "component")
