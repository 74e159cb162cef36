"""Content keys, staleness, upserts, versions, approvals, caches."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def digest(value: Column, n: int = 16) -> Column:
    """First n hex digits of the content's sha256."""
    return F.substring(F.sha2(value, 256), 1, n)


def content_key(fields: Sequence[str], n: int = 16) -> Column:
    """Digest of the canonical JSON of the fields in name order (nulls are left out by JSON)."""
    return digest(F.to_json(F.struct(*(F.col(f) for f in sorted(fields)))), n)


def needs_run(status: Column, stored: Column, current: Column) -> Column:
    """Skipped never runs; done runs again only when its key differs; everything else runs."""
    return ~(F.coalesce(status == "skipped", F.lit(False)) | (F.coalesce(status == "done", F.lit(False)) & stored.eqNullSafe(current) & stored.isNotNull()))


def changed(seen: Column, current: Column) -> Column:
    """Both are known and differ."""
    return F.coalesce((seen != "") & (current != "") & (seen != current), F.lit(False))


def settled(before: Column, after: Column) -> Column:
    return F.when(before.eqNullSafe(after), "done").otherwise("stale")


def latest(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The last version of each key; ties by the further columns of ``order``."""
    cols = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*cols), F.struct(*order)).alias("__r")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col(f"__r.{c}").alias(c) for c in cols))


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with rows of ``changes`` replaced or added by key."""
    return target.join(changes.select(*keys).distinct(), list(keys), "left_anti").unionByName(changes)


def adoptable(outputs: DataFrame, inputs: DataFrame, keys: Sequence[str], out_time: str, in_time: str) -> DataFrame:
    """Old outputs that no input is newer than."""
    newest = inputs.groupBy(*keys).agg(F.max(in_time).alias("__newest"))
    return outputs.join(newest, list(keys)).where(F.col("__newest") <= F.col(out_time)).drop("__newest")


class Conflict(Exception):
    """The stored version is not the one that was read."""


def save_if_unchanged(df: DataFrame, path: str, expected: int, stale_after: float = 3600.0) -> int:
    """Write ``df`` as the version after ``expected``; :class:`Conflict` if another writer came first.

    A version is a folder ``v=N``.  A writer first claims it by creating a marker, which
    the file system lets only one do, then writes aside and renames the finished folder
    into place, so no reader and no other writer sees a part of it.  The claim of a writer
    that died is taken over once it is ``stale_after`` seconds old.
    """
    spark = df.sparkSession
    new = expected + 1
    if (at := current_version(spark, path)) != expected:
        raise Conflict(f"{path} is at version {at}, not {expected}")
    name = spark._jvm.org.apache.hadoop.fs.Path
    claim, aside, place = name(f"{path}/_claims/v={new}"), name(f"{path}/_aside/{uuid.uuid4().hex}"), name(f"{path}/v={new}")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(claim) and not fs.exists(place) and time.time() - fs.getFileStatus(claim).getModificationTime() / 1000 > stale_after:
        fs.delete(claim, False)
    try:
        fs.create(claim, False).close()
    except Py4JJavaError as e:
        raise Conflict(f"version {new} of {path} is being written") from e
    try:
        df.write.parquet(aside.toString())
        if fs.exists(place) or not fs.rename(aside, place):
            raise Conflict(f"version {new} of {path} is there already")
    except BaseException:
        fs.delete(aside, True)
        if not fs.exists(place):
            fs.delete(claim, False)
        raise
    return new


def versions(spark, path: str, prefix: str = "v=") -> list[int]:
    """Numbers of the complete folders ``<prefix>N`` under ``path``, ascending."""
    name = spark._jvm.org.apache.hadoop.fs.Path
    p = name(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    found = [s.getPath() for s in fs.listStatus(p)]
    return sorted(int(x.getName()[len(prefix) :]) for x in found if x.getName().startswith(prefix) and fs.exists(name(x, "_SUCCESS")))


def current_version(spark, path: str) -> int:
    """The highest complete version under ``path`` (-1 without one)."""
    return max(versions(spark, path), default=-1)


def load_current(spark, path: str) -> tuple[DataFrame, int]:
    v = current_version(spark, path)
    return spark.read.parquet(f"{path}/v={v}"), v


def uncached(wanted: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``wanted`` that the cache does not hold."""
    return wanted.join(cache.select(*keys).distinct(), list(keys), "left_anti")


def next_status(current: Column, event: Column) -> Column:
    """pending -> running -> done, stale or failed; skipped stays."""
    return (
        F.when(current == "skipped", "skipped")
        .when((event == "start") & current.isin("pending", "failed", "stale"), "running")
        .when((event == "ok") & (current == "running"), "done")
        .when((event == "error") & (current == "running"), "failed")
        .when((event == "change") & (current == "done"), "stale")
        .when((event == "skip") & (current == "pending"), "skipped")
        .otherwise(current)
    )


def first_of(keys: Sequence[str], *order) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
