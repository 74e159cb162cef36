"""Choosing rows: work selection, threshold cascades, first matches, fallbacks, memos, patches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def choose(df: DataFrame, key: str, only: Sequence | None = None, pilot: Column | None = None, failed: Column | None = None, everything: bool = False) -> DataFrame:
    """Exactly one way of choosing: given keys, the pilot's rows, failed or stale rows, or all; none or several is an error."""
    ways = [only is not None, pilot is not None, failed is not None, everything]
    if sum(ways) != 1:
        raise ValueError("choose by exactly one of only, pilot, failed, everything")
    if only is not None:
        return df.where(F.col(key).isin(list(only)))
    return df if everything else df.where(pilot if pilot is not None else failed)


def cascade(df: DataFrame, keys: Sequence[str], score: str, evidence: Column, high: float, low: float) -> DataFrame:
    """Rows at the high threshold where a group has any with evidence there, else rows at the low one."""
    w = Window.partitionBy(*keys)
    x = df.where(F.col(score) >= low).withColumn("__ok", F.max(((F.col(score) >= high) & evidence).cast("int")).over(w))
    return x.where((F.col("__ok") == 0) | (F.col(score) >= high)).drop("__ok")


def first_match(left: DataFrame, right: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """``left`` with the first row of ``right`` by ``order`` under the same keys, or nulls."""
    cols = [c for c in right.columns if c not in keys]
    best = right.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("__r"))
    return left.join(best, list(keys), "left").select(*left.columns, *(F.col(f"__r.{c}").alias(c) for c in cols))


def with_fallback(df: DataFrame, special: DataFrame, general: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``value`` of the special table under the keys, else of the general one under the first key."""
    a = special.select(*keys, F.col(value).alias("__a"))
    b = general.select(keys[0], F.col(value).alias("__b"))
    x = df.join(a, list(keys), "left").join(b, keys[0], "left")
    return x.withColumn(value, F.coalesce("__a", "__b")).drop("__a", "__b")


def memo_misses(files: DataFrame, memo: DataFrame) -> DataFrame:
    """Files (path, length, modified) whose digest is not known for exactly this size and time."""
    return files.join(memo.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")


def stamp_conflicts(df: DataFrame, stored: str, current: str) -> DataFrame:
    """Rows whose stored stamp is set and differs from the current one."""
    return df.where(F.col(stored).isNotNull() & ~F.col(stored).eqNullSafe(F.col(current)))


def skip_pending(df: DataFrame, where: Column, status: str = "status") -> DataFrame:
    """Pending rows of a selection become skipped; others stay."""
    return df.withColumn(status, F.when(where & (F.col(status) == "pending"), "skipped").otherwise(F.col(status)))


def update_point(df: DataFrame, key: str, at, **values) -> DataFrame:
    """Set columns of the row with one key; a missing key is an error."""
    if not df.where(F.col(key) == at).limit(1).count():
        raise KeyError(at)
    for c, v in values.items():
        df = df.withColumn(c, F.when(F.col(key) == at, F.lit(v)).otherwise(F.col(c)))
    return df


def patch_nth(nodes: DataFrame, kind: str, n: int, field: str, value: str) -> DataFrame:
    """Set ``inputs[field]`` of the n-th node (by number) of a kind; an absent node is an error."""
    w = Window.partitionBy("kind").orderBy(F.col("id").cast("long"))
    x = nodes.withColumn("__n", F.row_number().over(w) - 1)
    hit = (F.col("kind") == kind) & (F.col("__n") == n)
    if not x.where(hit).limit(1).count():
        raise KeyError(f"{kind} number {n}")
    new = F.map_concat(F.map_filter("inputs", lambda k, _: k != field), F.create_map(F.lit(field), F.lit(value)))
    return x.withColumn("inputs", F.when(hit, new).otherwise(F.col("inputs"))).drop("__n")


def graph_json(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """id, json of a node graph: literals stay, links become [node, slot]."""
    refs = links.groupBy("id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", F.to_json(F.array(F.col("source"), F.col("slot").cast("string"))))))).alias("refs"))
    x = nodes.join(refs, "id", "left")
    every = F.map_concat("inputs", F.coalesce("refs", F.create_map().cast("map<string,string>")))
    return x.select("id", F.to_json(F.struct("kind", every.alias("inputs"))).alias("json"))


def require_labels(labels: DataFrame, groups: DataFrame) -> DataFrame:
    """group, label id of every name in a group; a name without a label is an error."""
    x = groups.join(labels, "name", "left")
    return x.select("group", F.when(F.col("label").isNotNull(), F.col("label")).otherwise(F.raise_error(F.concat(F.lit("no label "), "name")).cast("int")).alias("label"))


def nearest_value(df: DataFrame, bank: DataFrame, keys: Sequence[str], value: str, at: str, ties: Sequence[Column], digits: int) -> DataFrame:
    """Each row of ``df`` with the row of ``bank`` of its ``keys`` whose ``at`` is nearest to ``value``.

    Distances are compared rounded to ``digits`` decimals, which ``at`` does not exceed;
    among rows at one distance the smallest ``ties`` are taken.  Only the neighbours below
    and above can be nearest: both sides are sorted together and each row takes the last
    bank row before it and the first after it, so nothing is paired.
    """
    kept = [c for c in bank.columns if c not in keys]
    one = bank.groupBy(*keys, F.col(at).alias("__p")).agg(F.min(F.struct(F.struct(*ties).alias("t"), F.struct(*kept).alias("b"))).alias("__bank"))
    left = df.select(*keys, F.col(value).alias("__at"), F.struct(*df.columns).alias("__row"), F.lit(None).cast(one.schema["__bank"].dataType).alias("__bank"), F.lit(1).alias("__side"))
    right = one.select(*keys, F.col("__p").cast(df.schema[value].dataType).alias("__at"), F.lit(None).cast(left.schema["__row"].dataType).alias("__row"), "__bank", F.lit(0).alias("__side"))
    both = left.union(right)
    up, down = Window.partitionBy(*keys).orderBy("__at", "__side"), Window.partitionBy(*keys).orderBy(F.desc("__at"), "__side")
    both = both.withColumn("__below", F.last("__bank", True).over(up)).withColumn("__above", F.last("__bank", True).over(down)).where("__side = 1")
    near = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.round(F.abs(F.col("__at") - F.col(c)["b"][at]), digits).alias("far"), F.col(c)["t"].alias("t"), F.col(c)["b"].alias("b")))
    best = both.select("__row", F.array_min(F.array(near("__below"), near("__above"))).alias("__best"))
    return best.select(*(F.col(f"__row.{c}").alias(c) for c in df.columns), *(F.col(f"__best.b.{c}").alias(c) for c in kept))
