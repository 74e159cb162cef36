"""Operators over ordered series: differences, runs, events, smoothing, window search, folds.

A series is named by ``keys`` and ordered by ``order``; every function keeps series
apart, so work is partitioned by ``keys`` and one series is read in order by one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType


def over(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def index_frames(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "frame") -> DataFrame:
    """Dense 0-based position in each series."""
    return df.withColumn(name, (F.row_number().over(over(keys, order)) - 1).cast("long"))


def abs_difference(value: str, keys: Sequence[str], order: Sequence[str], first: float | None = None) -> Column:
    """|x - previous x|; ``first`` for the first row (null by default)."""
    d = F.abs(F.col(value) - F.lag(value).over(over(keys, order)))
    return d if first is None else F.coalesce(d, F.lit(first))


def runs(df: DataFrame, flag: Column, keys: Sequence[str], order: str) -> DataFrame:
    """Maximal half-open runs [start, stop) of consecutive positions where ``flag`` holds (gaps and islands)."""
    at = df.where(flag).select(*keys, order).withColumn("__island", F.col(order) - F.row_number().over(over(keys, [order])))
    out = at.groupBy(*keys, "__island").agg(F.min(order).alias("start"), (F.max(order) + 1).alias("stop"))
    return out.withColumn("length", F.col("stop") - F.col("start")).drop("__island")


def track_events(df: DataFrame, present: Column, area: str, score: str, keys: Sequence[str], order: str, jump: float = 3.0, low: float = 0.42) -> DataFrame:
    """keys, order, type: disappeared, reappeared, area_jump, low_confidence.

    An absent frame gives only ``disappeared``, and only where the series starts absent
    or was present before; a present frame may give several.
    """
    w = over(keys, [order])
    x = df.withColumn("__p", F.coalesce(present, F.lit(False)))
    x = x.withColumn("__was", F.lag("__p").over(w)).withColumn("__before", F.lag(area).over(w))
    ratio = F.try_divide(F.col(area), F.col("__before"))
    kinds = F.array(
        F.when(~F.col("__p") & F.coalesce(F.col("__was"), F.lit(True)), "disappeared"),
        F.when(F.col("__p") & (F.col("__was") == F.lit(False)), "reappeared"),
        F.when(F.col("__p") & F.col("__was") & ((ratio > jump) | (ratio < 1 / jump)), "area_jump"),
        F.when(F.col("__p") & (F.col(score) < low), "low_confidence"),
    )
    return x.select(*keys, order, F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("type"))


def centred_mean(df: DataFrame, value: str, keys: Sequence[str], order: str, window: int, name: str = "smooth") -> DataFrame:
    """Zero-phase moving average with the end values repeated beyond the ends.

    The window is made odd and no longer than the series (then the largest odd length
    that fits), as a series of n rows allows.
    """
    w, whole = over(keys, [order]), Window.partitionBy(*keys)
    p_wanted = (window | 1) // 2
    x = df.withColumn("__n", F.count(F.lit(1)).over(whole)).withColumn("__i", F.row_number().over(w) - 1)
    x = x.withColumn("__p", F.least(F.lit(p_wanted), ((F.col("__n") - 1) / 2).cast("int")))
    x = x.withColumn("__first", F.first(value).over(w)).withColumn("__last", F.last(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    # the half width is constant unless the series is shorter than the window; sums for each possible width
    total = None
    for p in range(p_wanted + 1):
        s = F.sum(value).over(w.rowsBetween(-p, p))
        total = F.when(F.col("__p") == p, s) if total is None else total.when(F.col("__p") == p, s)
    head = F.greatest(F.lit(0), F.col("__p") - F.col("__i"))
    tail = F.greatest(F.lit(0), F.col("__p") - (F.col("__n") - 1 - F.col("__i")))
    return x.withColumn(name, (total + head * F.col("__first") + tail * F.col("__last")) / (2 * F.col("__p") + 1)).drop("__n", "__i", "__p", "__first", "__last")


def carry(df: DataFrame, value: str, keys: Sequence[str], order: str, name: str = "filled") -> DataFrame:
    """Last known value, and before the first known one the first."""
    w = over(keys, [order])
    back = F.first(value, True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(name, F.coalesce(F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0)), back))


def persistent(flag: Column, keys: Sequence[str], order: str, half: int = 2, share: float = 0.75) -> Column:
    """Set now, and in at least ``share`` of the rows around (the window shrinks at the ends)."""
    return flag & (F.avg(flag.cast("int")).over(over(keys, [order]).rowsBetween(-half, half)) >= share)


def window_scores(df: DataFrame, motion: str, texture: str, keys: Sequence[str], order: str, width: int, step: int) -> DataFrame:
    """start and score of every full window at multiples of ``step``: moderate motion, texture and variation win."""
    w = over(keys, [order]).rowsBetween(0, width - 1)
    x = df.withColumn("m", F.avg(motion).over(w)).withColumn("t", F.avg(texture).over(w)).withColumn("sd", F.stddev_pop(motion).over(w)).withColumn("__n", F.count(F.lit(1)).over(w))
    x = x.where((F.col("__n") == width) & (F.col(order) % step == 0))
    score = 0.45 * F.least(F.col("m") / 6, F.lit(1.0)) + 0.25 * F.least(F.col("t") / 250, F.lit(1.0)) + 0.30 * F.least(F.col("sd") / 3, F.lit(1.0))
    return x.select(*keys, F.col(order).alias("start"), "m", score.alias("score"))


def best_window(scores: DataFrame, keys: Sequence[str], least_motion: float = 0.4) -> DataFrame:
    """The best-scored window of each series; the earliest of equals."""
    return scores.where(F.col("m") >= least_motion).groupBy(*keys).agg(F.max_by("start", F.struct("score", -F.col("start"))).alias("start"), F.max("score").alias("score"))


def best_mean_window(df: DataFrame, value: str, keys: Sequence[str], order: str, width: int) -> DataFrame:
    """The full window of the highest mean; the earliest of equals."""
    w = over(keys, [order]).rowsBetween(0, width - 1)
    x = df.withColumn("mean", F.avg(value).over(w)).withColumn("__n", F.count(F.lit(1)).over(w)).where(F.col("__n") == width)
    return x.groupBy(*keys).agg(F.max_by(order, F.struct("mean", -F.col(order))).alias("start"), F.max("mean").alias("mean"))


def normalised(df: DataFrame, value: str, keys: Sequence[str], low: float = 0.01, high: float = 0.99, top: int = 255, name: str = "level") -> DataFrame:
    """Clip to the group's own percentile range and scale to 0..top, cut to integers; a flat range gives 0."""
    from .metrics import exact_percentiles

    found = exact_percentiles(df, value, keys, (low, high))
    span = found.select(*(F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)), F.col(found.columns[-2]).alias("__lo"), F.col(found.columns[-1]).alias("__hi"))
    x = df.join(span, [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)], "left").drop(*(f"__key{i}" for i in range(len(keys))))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(value) - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))))
    return x.withColumn(name, F.when(F.col("__hi") - F.col("__lo") < 1e-6, 0).otherwise((share * top).cast("int"))).drop("__lo", "__hi")


def margin(df: DataFrame, value: str, keys: Sequence[str], tie: str) -> DataFrame:
    """Best, second best and their distance in each group; a single row has a margin of its own value."""
    w = Window.partitionBy(*keys).orderBy(F.desc(value), tie)
    x = df.withColumn("__r", F.row_number().over(w)).where("__r <= 2")
    best, second = F.max(F.when(F.col("__r") == 1, F.col(value))), F.max(F.when(F.col("__r") == 2, F.col(value)))
    return x.groupBy(*keys).agg(best.alias("best"), second.alias("second"), (best - F.coalesce(second, F.lit(0.0))).alias("margin"))


def spaced(df: DataFrame, keys: Sequence[str], order: str, k: int) -> DataFrame:
    """k evenly spaced rows of each series, positions cut to integers; shorter series repeat none."""
    x = df.withColumn("__i", F.row_number().over(over(keys, [order])) - 1).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    wanted = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (F.col("__n") - 1) / F.lit(max(1, k - 1))).cast("int"))
    return x.where(F.array_contains(wanted, F.col("__i"))).drop("__i", "__n")


def held_out(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], share: int, name: str = "split") -> DataFrame:
    """Every ``share``-th row by rank is held out, never the first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    i = F.row_number().over(w) - 1
    return df.withColumn(name, F.when((i > 0) & (i % share == 0), "holdout").otherwise("train"))


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], step: Callable[[object, list[list]], tuple[object, list[list] | None]], columns: Sequence[str], schema: str, finish: Callable[[object], list[list] | None] | None = None) -> DataFrame:
    """An order-dependent fold of each series, streaming over sorted partitions.

    ``step(state, columns)`` gets the state (None at a series' begin) and the values of
    ``columns`` of a stretch of one series as lists; it returns the next state and the
    columns of ``schema`` as lists, of any one length, or None.  ``finish(state)`` ends
    a series in the same way.  Keys stand before the columns of ``schema`` in the result
    and are carried as they came, nulls (which are one series) and all; integers stay
    exact.  A task holds one state and one Arrow batch, however long a series is.
    """
    n = len(keys)
    ordered = df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, *order).select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), *columns)
    more = StructType.fromDDL(schema)
    out = StructType([*(StructField(k, df.schema[k].dataType) for k in keys), *more])
    types = [to_arrow_type(f.dataType) for f in more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None  # the open series' key columns, one row each

        def rows(key: list[pa.Array], got: list[list] | None) -> list[pa.RecordBatch]:
            if not got or not len(got[0]):
                return []
            zero = pa.array(np.zeros(len(got[0]), np.int64))
            return [pa.RecordBatch.from_arrays([*(k.take(zero) for k in key), *(pa.array(v, t) for v, t in zip(got, types))], names=out.names)]

        for batch in batches:
            if not batch.num_rows:
                continue
            key = [batch.column(i) for i in range(n)]
            if last is not None:  # the open series goes before, to be compared like the rest
                key = [pa.concat_arrays([x, y]) for x, y in zip(last, key)]
            codes = [k.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False) for k in key]
            new = np.zeros(len(key[0]) - 1, bool)
            for c in codes:
                new |= c[1:] != c[:-1]
            shift = 0 if last is None else 1
            edge = np.flatnonzero(new) + 1 - shift
            fresh = last is None or bool(new[0])
            starts = [0, *edge[edge > 0].tolist()]
            cols = [batch.column(n + i).to_pylist() for i in range(len(columns))]
            done: list[pa.RecordBatch] = []
            for i, (x, y) in enumerate(zip(starts, [*starts[1:], batch.num_rows])):
                if i or fresh:
                    if last is not None and finish:
                        done += rows(last, finish(state))
                    state = None
                last = [k.slice(x + shift, 1) for k in key]
                state, got = step(state, [c[x:y] for c in cols])
                done += rows(last, got)
            last = [pa.concat_arrays([k]) for k in last]
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if last is not None and finish:
            yield from rows(last, finish(state))

    return ordered.mapInArrow(run, out)


def deadband(df: DataFrame, value: str, keys: Sequence[str], order: str, dead: float) -> DataFrame:
    """The output follows the input only when it is at least ``dead`` away from the last output; a null follows nothing."""

    def step(held, cols):
        out = []
        for v in cols[1]:
            if v is not None and (held is None or abs(v - held) >= dead):
                held = float(v)
            out.append(held)
        return held, [cols[0], out]

    return fold(df, keys, [order], step, [order, value], f"`{order}` {dict(df.dtypes)[order]}, held double")


def smoothed(df: DataFrame, value: str, keys: Sequence[str], order: str, keep: float) -> DataFrame:
    """First-order recursive smoothing that takes values of 0 and 1 as they are; a null changes nothing."""

    def step(held, cols):
        out = []
        for v in cols[1]:
            if v is not None:
                held = float(v) if held is None or v in (0.0, 1.0) else keep * held + (1 - keep) * v
            out.append(held)
        return held, [cols[0], out]

    return fold(df, keys, [order], step, [order, value], f"`{order}` {dict(df.dtypes)[order]}, smooth double")
