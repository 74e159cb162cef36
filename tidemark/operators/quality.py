"""Data-quality expectations: every check returns violation rows (subject, problem)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, subject: str, rules: Mapping[str, Column]) -> DataFrame:
    """One row per broken rule; a rule that is null counts as broken."""
    broken = F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()))
    return df.select(F.col(subject).cast("string").alias("subject"), F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("problem"))


def require(found: DataFrame, most: int = 12) -> None:
    """Raise with the first few violations, if any; all are counted."""
    rows = found.limit(most).collect()
    if rows:
        raise ValueError(f"{found.count()} violations, such as " + "; ".join(f"{r['subject']}: {r['problem']}" for r in rows))


def missing(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(present.select(*keys).distinct(), list(keys), "left_anti")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def schema_diff(a: DataFrame, b: DataFrame, key: str, shape: str) -> DataFrame:
    """key, status: missing (only in a), extra (only in b), mismatch or same."""
    x = a.select(key, F.col(shape).alias("__a"), F.lit(1).alias("__ina"), F.lit(0).alias("__inb"))
    y = b.select(key, F.col(shape).alias("__a"), F.lit(0).alias("__ina"), F.lit(1).alias("__inb"))
    both = x.union(y).groupBy(key).agg(F.max("__ina").alias("ina"), F.max("__inb").alias("inb"), F.count_distinct("__a").alias("shapes"))
    return both.select(key, F.when(F.col("inb") == 0, "missing").when(F.col("ina") == 0, "extra").when(F.col("shapes") > 1, "mismatch").otherwise("same").alias("status"))
