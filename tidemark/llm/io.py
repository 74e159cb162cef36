"""Reading tables and cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import cut, spread

__all__ = ["cut", "documents", "table", "width"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Columns of the documents, for per-row work on all cores."""
    return spread(table(spark, sf_dir, "documents").select(*columns))


def width(spark: SparkSession) -> int:
    """Partitions that a key-dealt repartition should have."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
