"""What the named queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.series import index_frames


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """``events`` as one series per user: frame, value and more columns."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value", *more)
    return index_frames(e, ["user_id"], ["ts", "event_id"]).select("user_id", "frame", "value", *more)


FRAMES = "frames AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame FROM events)"


def r6(name: str):
    return F.round(F.col(name), 6).alias(name)
