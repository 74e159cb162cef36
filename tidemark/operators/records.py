"""Records with runs by variant: lookups with the old form as fallback, mirrored updates, completed samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASELINE = "baseline"


def run_field(runs: Column, top: Column, variant: Column, field: str, default: Column) -> Column:
    """A variant's field from its run; without a run the baseline has the record's own field, other variants the default."""
    own = F.try_element_at(runs, variant)
    there = F.coalesce(F.map_contains_key(runs, variant), F.lit(False))
    return F.when(there, F.coalesce(own[field], default)).when(variant == BASELINE, F.coalesce(top, default)).otherwise(default)


def record_run(df: DataFrame, runs: str, variant: str, fields: dict[str, Column]) -> DataFrame:
    """One variant's run with the fields put in; only the baseline's go to the record's own columns too."""
    kind = df.schema[runs].dataType.valueType
    old = F.try_element_at(F.col(runs), F.lit(variant))
    new = F.struct(*((fields[f.name] if f.name in fields else old[f.name]).cast(f.dataType).alias(f.name) for f in kind))
    rest = F.map_filter(F.coalesce(F.col(runs), F.create_map().cast(df.schema[runs].dataType)), lambda k, _: k != variant)
    top = fields if variant == BASELINE else {}
    return df.select(*((top[c].cast(df.schema[c].dataType).alias(c) if c in top else F.col(c)) for c in df.columns if c != runs), F.map_concat(rest, F.create_map(F.lit(variant), new)).alias(runs)).select(df.columns)


def completed_runs(df: DataFrame, keys: Sequence[str], runs: str, seconds: str = "seconds") -> DataFrame:
    """keys, variant and the run's fields of every run that is done and took time."""
    x = df.select(*keys, F.explode(runs).alias("variant", "__r"))
    return x.where((F.col("__r.status") == "done") & (F.col(f"__r.{seconds}") > 0)).select(*keys, "variant", "__r.*")


def interval_or_whole(start: Column, stop: Column, total: Column) -> Column:
    """The given interval where both ends are known, else the whole stream."""
    given = start.isNotNull() & stop.isNotNull()
    return F.struct(F.when(given, start).otherwise(F.lit(0)).alias("start"), F.when(given, stop).otherwise(total).alias("stop"))


def narrowed(group: Column, allowed: Column, keep: Column) -> Column:
    """``keep`` where it is given; else what of the group is allowed, all of it if nothing is said."""
    return F.coalesce(keep, F.when(allowed.isNull(), group).otherwise(F.array_intersect(group, allowed)))


def with_value(fields: dict[str, Column]) -> Column:
    """A JSON object of the fields that are neither null nor empty lists or texts."""
    return F.to_json(F.struct(*(F.when(F.length(v.cast("string")).isNotNull() & ~v.cast("string").isin("", "[]"), v).alias(k) for k, v in fields.items())))


def sorted_hits(hits: DataFrame, by: str = "path", path: str = "path", modified: str = "modified", size: str = "length", limit: int = 0) -> DataFrame:
    """Found files by path, by time or by size (the last or largest first, equal ones by path)."""
    order = {"path": [path], "mtime": [F.desc(modified), path], "size": [F.desc(size), path]}[by]
    x = hits.orderBy(*order)
    return x.limit(limit) if limit > 0 else x


def iou_by_frame(df: DataFrame, keys: Sequence[str], frame: str, a: Column, b: Column) -> DataFrame:
    """keys, iou: each frame's intersection over union (0 without either), then the median over the frames."""
    each = df.groupBy(*keys, frame).agg((F.count_if(a & b) / F.greatest(F.lit(1), F.count_if(a | b))).alias("__iou"))
    return each.groupBy(*keys).agg(F.median("__iou").alias("iou"))
