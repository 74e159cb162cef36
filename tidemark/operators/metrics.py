"""Metric roll-ups: masked means, percentiles, palettes, overlaps, histograms, baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mean_of_means(df: DataFrame, value: str, inner: Sequence[str], outer: Sequence[str], mask: Column | None = None) -> DataFrame:
    """Mean per ``inner`` over the rows that ``mask`` selects, then the mean of those that have any."""
    x = df if mask is None else df.where(mask)
    first = x.groupBy(*inner).agg(F.avg(value).alias("__m"))
    return first.groupBy(*outer).agg(F.avg("__m").alias("mean"))


def ratio_of_sums(df: DataFrame, above: str, below: str, keys: Sequence[str], name: str = "ratio") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(above).alias("total_above"), F.sum(below).alias("total_below"), F.try_divide(F.sum(above), F.sum(below)).alias(name))


def percentiles(value: str, points: Sequence[float]) -> list[Column]:
    """Exact percentiles with linear interpolation, named p01, p25 ..."""
    return [F.percentile(value, F.lit(p)).alias(f"p{round(p * 100):02d}") for p in points]


def exact_percentiles(df: DataFrame, value: str, keys: Sequence[str], points: Sequence[float], bins: int = 4096) -> DataFrame:
    """keys and p01, p25 ...: exact percentiles with linear interpolation, also of few very large groups.

    A group's range is cut into ``bins`` equal parts.  Their counts, which combine on the
    map side, tell in which parts the wanted ranks lie, and only the distinct values of
    those are sorted.  So no task holds or sorts a whole group.  Nulls do not count.
    """
    keys = list(keys)
    x = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    lim = x.groupBy(*keys).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.count("*").alias("__n"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    part = F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col("__v") - F.col("__lo")) / width))).otherwise(F.lit(0)).cast("int")
    lim_, x_ = lim.alias("l"), x.alias("x")
    cells = x_.join(lim_, [F.col(f"x.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]).select(*(F.col(f"x.{k}").alias(k) for k in keys), "__v", "__n", part.alias("__part"))
    counts = cells.groupBy(*keys, "__part").agg(F.count("*").alias("__c"), F.first("__n").alias("__n"))
    before = F.coalesce(F.sum("__c").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor((F.col("__n") - 1) * p), F.ceil((F.col("__n") - 1) * p)) for p in points))))
    counts = counts.withColumn("__before", before).withColumn("__ranks", F.filter(ranks, lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__c")))).where(F.size("__ranks") > 0)
    c_, v_ = counts.alias("c"), cells.groupBy(*keys, "__part", "__v").agg(F.count("*").alias("__m")).alias("v")
    met = v_.join(c_, [*(F.col(f"v.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys), F.col("v.__part") == F.col("c.__part")])
    met = met.select(*(F.col(f"v.{k}").alias(k) for k in keys), F.col("v.__part").alias("__part"), "__v", "__m", "__before", "__ranks", "__n")
    upto = F.sum("__m").over(Window.partitionBy(*keys, "__part").orderBy("__v")) + F.col("__before")
    at = met.withColumn("__upto", upto).withColumn("__hit", F.filter("__ranks", lambda r: (r < F.col("__upto")) & (r >= F.col("__upto") - F.col("__m"))))
    at = at.select(*keys, "__v", "__n", F.explode("__hit").alias("__rank"))

    def of(p: float) -> Column:
        r = (F.col("__n") - 1) * p
        pick = lambda k: F.max(F.when(F.col("__rank") == k, F.col("__v")))
        low, high, share = pick(F.floor(r)), pick(F.ceil(r)), F.first(r - F.floor(r))
        return (low + (high - low) * share).alias(f"p{round(p * 100):02d}")

    return at.groupBy(*keys).agg(*(of(p) for p in points))


def within(value: Column, limits: Sequence[float]) -> list[Column]:
    """Shares of rows whose absolute value is at most each limit, named within_1 ..."""
    return [F.avg((F.abs(value) <= t).cast("double")).alias(f"within_{t:g}") for t in limits]


def palette(df: DataFrame, group: Sequence[str], channels: Sequence[str], floor_share: float, floor_rows: int) -> DataFrame:
    """Median per channel and share of each group; groups of too few rows are dropped."""
    total = df.agg(F.count("*").alias("__t"))
    x = df.groupBy(*group).agg(*(F.median(c).alias(c) for c in channels), F.count("*").alias("n"))
    x = x.join(F.broadcast(total))  # one row
    return x.where(F.col("n") >= F.greatest(F.lit(floor_rows), floor_share * F.col("__t"))).withColumn("share", F.col("n") / F.col("__t")).drop("__t")


def overlap(a: Column, b: Column) -> list[Column]:
    """iou, and counts of both, either."""
    both, either = F.count_if(a & b), F.count_if(a | b)
    return [both.alias("both"), either.alias("either"), (both / F.greatest(F.lit(1), either)).alias("iou")]


def histogram(df: DataFrame, keys: Sequence[str], angle: Column, weight: Column, bins: int) -> DataFrame:
    """Weighted, normalised histogram of angles modulo pi, with empty bins as zeros."""
    bin_of = F.least(F.lit(bins - 1), F.floor(F.pmod(angle, F.lit(3.141592653589793)) / 3.141592653589793 * bins)).cast("int")
    h = df.groupBy(*keys, bin_of.alias("bin")).agg(F.sum(weight).alias("w"))
    every = df.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    x = every.join(h, [*keys, "bin"], "left").withColumn("w", F.coalesce("w", F.lit(0.0)))
    return x.withColumn("p", F.col("w") / (F.sum("w").over(Window.partitionBy(*keys)) + 1e-9)).drop("w")


def chi_square(a: Column, b: Column) -> Column:
    """0.5 * sum of squared differences over sums, as an aggregate over bins."""
    return 0.5 * F.sum((a - b) * (a - b) / (a + b + 1e-9))


def against_baseline(df: DataFrame, variant: str, baseline: str, metrics: Sequence[str]) -> DataFrame:
    """Percent change of each metric to the baseline's row, null where the baseline is zero."""
    base = df.where(F.col(variant) == baseline).select(*(F.col(m).alias(f"__{m}") for m in metrics))
    x = df.join(F.broadcast(base))  # one row
    return x.select(variant, *(F.round(100 * (F.try_divide(F.col(m), F.col(f"__{m}")) - 1), 1).alias(f"{m}_change") for m in metrics))


def group_checksum(df: DataFrame, keys: Sequence[str], member: Column) -> DataFrame:
    """Digest of the sorted member digests of each group."""
    return df.groupBy(*keys).agg(F.md5(F.concat_ws(",", F.sort_array(F.collect_list(F.md5(member))))).alias("checksum"), F.count("*").alias("members"))
