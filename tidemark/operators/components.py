"""Connected components of an undirected graph, as a converging DataFrame loop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, cut: Callable[[DataFrame], DataFrame], a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component``: the smallest node that each node of ``edges`` reaches.

    Each round takes the smallest label among neighbours (combined on the map side)
    and then follows the label of the label, so chains of length d need about log d
    rounds.  ``cut`` stores a round's labels and drops their lineage; only the number
    of changed labels comes to the driver.  Null ends and self-links are ignored.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = cut(pairs.union(pairs.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        step = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("new"))
        up = labels.select(F.col("node").alias("new"), F.col("component").alias("top"))
        step = cut(step.join(up, "new").select("node", "old", F.least("new", "top").alias("component")))
        moved = step.where("component <> old").limit(1).count()
        labels = step.select("node", "component")
        if not moved:
            return labels
