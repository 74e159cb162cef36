"""Structured Streaming over event files: windows, de-duplication, upserts, stateful runs.

Every function takes a streaming (or batch) DataFrame with a TIMESTAMP column and
returns one; the results after ``availableNow`` equal the batch operators' results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def read_files(spark: SparkSession, path: str, schema: StructType, time: str = "ts", files: int | None = None) -> DataFrame:
    """A stream of Parquet files; a TIMESTAMP_NTZ time column becomes TIMESTAMP, as watermarks need."""
    r = spark.readStream.schema(schema)
    if files:
        r = r.option("maxFilesPerTrigger", files)
    return r.parquet(path).withColumn(time, F.col(time).cast("timestamp"))


def tumbling(df: DataFrame, width: str, by: str, value: str, time: str = "ts", late: str = "1 hour") -> DataFrame:
    x = df.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by)
    return x.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def sliding(df: DataFrame, width: str, slide: str, by: str, value: str, time: str = "ts", late: str = "1 hour") -> DataFrame:
    x = df.withWatermark(time, late).groupBy(F.window(time, width, slide).alias("w"), by)
    return x.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def sessions(df: DataFrame, gap: str, by: str, value: str, time: str = "ts", late: str = "1 hour") -> DataFrame:
    """A gap as long as ``gap`` starts a new session."""
    x = df.withWatermark(time, late).groupBy(by, F.session_window(time, gap).alias("w"))
    return x.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(by, F.col("w.start").alias("start"), "n", "total")


def once(df: DataFrame, keys: list[str], time: str = "ts", late: str = "1 hour") -> DataFrame:
    """The first of the rows that share ``keys``; state is dropped behind the watermark."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def presence_runs(df: DataFrame, key: str, order: str, value: str, least: float, idle_ms: int | None = None) -> DataFrame:
    """key, start, stop of closed absence runs as rows arrive in order; the open run of a key is its state.

    With ``idle_ms`` a key that nothing has arrived for in that time (by the clock) ends
    its open run behind its last row and gives up its state, so state is bounded by the
    keys that are active; without it every key keeps two numbers for ever.
    """

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, last = state.get if state.exists else (-1, -1)
        out = []
        if state.hasTimedOut:
            out = [(group[0], start, last + 1)] if start >= 0 else []
            state.remove()
        else:
            for b in batches:
                for at, v in b.sort_values(order)[[order, value]].itertuples(index=False, name=None):
                    if v <= least and start < 0:
                        start = at
                    elif v > least and start >= 0:
                        out.append((group[0], start, at))
                        start = -1
                    last = at
            state.update((int(start), int(last)))
            if idle_ms:
                state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame(out, columns=[key, "start", "stop"]).astype({key: "int64", "start": "int64", "stop": "int64"})

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout
    return df.groupBy(key).applyInPandasWithState(step, f"{key} long, start long, stop long", "start long, last long", "append", timeout)


def upsert_into(df: DataFrame, path: str, keys: list[str], order: list[str], checkpoint: str, compact_every: int = 16):
    """Merge a stream into a table of latest rows; :func:`upserted` reads it.

    A micro-batch writes its own latest rows only, as ``deltas/b=N``; every
    ``compact_every``-th merges what has gathered into a new whole table ``v=N``.  A batch
    that is replayed after a failure writes the same folder again, so every batch counts once.
    """
    from ..operators import state as S

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        S.latest(batch, keys, *order).write.mode("overwrite").parquet(f"{path}/deltas/b={number}")
        if (number + 1) % compact_every == 0 and S.current_version(spark, path) < number:
            upserted(spark, path, keys, order).write.mode("overwrite").parquet(f"{path}/v={number}")

    return df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upserted(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """The latest rows of the last whole table and of the batches since."""
    from ..operators import state as S

    base = S.current_version(spark, path)
    newer = [n for n in S.versions(spark, f"{path}/deltas", "b=") if n > base]
    parts = [f"{path}/v={base}"] * (base >= 0) + [f"{path}/deltas/b={n}" for n in newer]
    rows = spark.read.parquet(parts[0])
    for p in parts[1:]:
        rows = rows.unionByName(spark.read.parquet(p))
    return S.latest(rows, keys, *order)


def drain(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there and return its rows (for tests and small results)."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
