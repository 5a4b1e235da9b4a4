"""Connected components of a table of links, by rounds that contract the links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node in ``links``; the component is its smallest node.

    In each round a node joins its smallest neighbour's parent, if that is smaller than
    itself; links are then between what was joined, and those inside are dropped.  The
    smallest node never joins another, so it names its component at the end.  Null ends
    and links of a node to itself are ignored.  Every round is stored.
    """
    def between(x, y):
        return F.least(x, y).alias("u"), F.greatest(x, y).alias("v")

    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = written(links.where(x != y).select(*between(x, y)).distinct(), "links")
    labels = None
    while True:
        near = edges.union(edges.select("v", "u")).groupBy("u").agg(F.min("v").alias("v"))
        near = written(near.select(F.col("u").alias("node"), F.least("u", "v").alias("parent")), "parents")
        above = near.select(F.col("node").alias("p_node"), F.col("parent").alias("p_parent"))
        step = written(near.join(above, near["parent"] == above["p_node"])
                       .select("node", F.col("p_parent").alias("to")), "parents")
        if labels is None:
            labels = step.select("node", F.col("to").alias("component"))
        else:
            moved = step.select(F.col("node").alias("old"), "to")
            labels = written(labels.join(moved, labels["component"] == moved["old"], "left")
                             .select("node", F.coalesce("to", "component").alias("component")), "labels")
        low = step.select(F.col("node").alias("u"), F.col("to").alias("x"))
        high = step.select(F.col("node").alias("v"), F.col("to").alias("y"))
        edges = written(edges.join(low, "u").join(high, "v").where("x <> y")
                        .select(*between(F.col("x"), F.col("y"))).distinct(), "links")
        if edges.isEmpty():
            return labels
