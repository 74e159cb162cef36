"""Queries over tables with odd rows, against their SQL."""

import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from pyspark.sql import functions as F

from tests.oracle import duck, spark_rows
from tidemark.operators.intervals import windows
from tidemark.plans import registry
from tidemark.session import cut


def with_table(data, folder, name, columns):
    """A folder like ``data`` with another table ``name``: the given columns, of the types that are there."""
    for p in Path(data).glob("*.parquet"):
        if p.stem != name:
            (folder / p.name).symlink_to(p)
    kinds = pq.read_schema(f"{data}/{name}.parquet")
    n = len(next(iter(columns.values())))
    pq.write_table(pa.table({f.name: pa.array(columns.get(f.name, [None] * n), f.type) for f in kinds}), folder / f"{name}.parquet")
    return str(folder)


def same(spark, name, d):
    got = spark_rows(registry.queries()[name](spark, d))
    assert got == duck(d, registry.oracle_sql()[name])
    return got


def test_clipped_share_of_zero_values(spark, data, tmp_path):
    values = [0.0, 50.0, 130.0, -0.0, 240.0, -5.0, None, 10.0, None, 0.0, float("inf"), 300.0, float("nan"), 1.0, 119.0]
    users = [1, 1, 1, 2, 3, 3, 4, 4, 5, None, 6, 6, 7, 7, 8]
    n = len(values)
    d = with_table(data, tmp_path, "events", {"event_id": range(n), "ts": [dt.datetime(2024, 1, 1)] * n, "user_id": users, "value": values})
    assert len(same(spark, "clipped_share_gate", d)[1]) == 9


def test_size_estimates_of_a_loop_stay_small(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x = spark.range(32).select(F.col("id").alias("node"), F.greatest(F.col("id") - 1, F.lit(0)).alias("up"))
        for _ in range(6):
            x = cut(x.join(x.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", F.col("top").alias("up")))
            assert x._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 2**63
        assert sorted(map(tuple, x.collect())) == [(i, 0) for i in range(32)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_windows_of_one_file_and_of_one_long_segment_go_to_all_tasks(spark, data, tmp_path):
    keys = [*range(-2, 700), 200_000, None]
    d = with_table(data, tmp_path, "part", {"p_partkey": keys})
    same(spark, "chunk_length_sweep", d)
    lengths = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("key"))
    whole = windows(lengths, "key", 81, 8)
    small = windows(lengths, "key", 81, 8, 5)
    assert spark_rows(small) == spark_rows(whole)
    for df in (registry.queries()["chunk_length_sweep"](spark, data), small):
        counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert 2 * max(counts) <= sum(counts)


def test_files_of_long_segments_windows_are_small(spark, data, tmp_path):
    d = with_table(data, tmp_path, "part", {"p_partkey": range(100_000, 100_240)})
    assert len(same(spark, "chunk_length_sweep", d)[1]) > 300_000
    registry.queries()["chunk_length_sweep"](spark, d).write.parquet(str(tmp_path / "out"))
    files = [pq.ParquetFile(p).metadata for p in (tmp_path / "out").glob("*.parquet")]
    size = sum(m.row_group(i).column(j).total_compressed_size for m in files for i in range(m.num_row_groups) for j in range(m.num_columns))
    rows = sum(m.num_rows for m in files)
    assert size < rows
    many = windows(spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("key")), "key", 81, 8, most=10_000)
    counts = [r["count"] for r in many.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == rows and max(counts) <= 2 * 10_000
