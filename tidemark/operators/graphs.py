"""Small graphs: inheritance chains and depths of a directed acyclic graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def chain(df: DataFrame, name: str, up: str, most: int = 64) -> DataFrame:
    """name, path (joined by ``>``), looped: each name's ancestors until there is none or one repeats.

    One join a level; ``most`` levels are an error, not a cut.
    """
    step = df.select(F.col(name).alias("__name"), F.col(up).alias("__up"))
    x = df.select(name, F.col(up).alias("at"), F.array(F.col(name)).alias("path"))
    done = None
    for _ in range(most):
        ended = x.at.isNull() | F.array_contains("path", F.col("at"))
        part = x.where(ended).select(name, F.array_join("path", ">").alias("path"), F.col("at").isNotNull().alias("looped"))
        done = part if done is None else done.union(part)
        x = cut(x.where(~ended).join(step, x.at == step["__name"]).select(name, F.col("__up").alias("at"), F.concat("path", F.array("__name")).alias("path")))
        if not x.limit(1).count():
            return done
    raise ValueError(f"a chain has more than {most} levels")


def depths(edges: DataFrame, a: str = "a", b: str = "b", most: int = 256) -> DataFrame:
    """node, depth: the longest way from a source; a cycle is an error after ``most`` levels."""
    e = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct())
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    level = nodes.join(e.select(F.col("b").alias("node")).distinct(), "node", "left_anti").withColumn("depth", F.lit(0).cast("long"))
    every = level
    for _ in range(most):
        level = cut(level.join(e, F.col("node") == F.col("a")).groupBy(F.col("b").alias("node")).agg(F.max(F.col("depth") + 1).alias("depth")))
        if not level.limit(1).count():
            return every.groupBy("node").agg(F.max("depth").alias("depth"))
        every = every.union(level)
    raise ValueError("the graph has a cycle")
