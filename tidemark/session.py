"""Session helpers: a local session for tests and benches, and shipping this package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Spark 4.1 may read a union of equally partitioned inputs as partitioned alike although adaptive
#: execution has merged their partitions differently; grouping such a union then splits keys.
#: Arrow batches are bounded by bytes as well as rows, as rows may be very long.
SETTINGS = {"spark.sql.unionOutputPartitioning": "false", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
#: Spark drops the shuffle files of an action as soon as it has ended, where this is set.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local(cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """Settings that right results need."""
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint; its shuffle files go at once.

    The folder is ``spark.checkpoint.dir``.  A temporary one is made only where driver
    and executors are one process (``local`` masters); elsewhere a missing setting is
    an error, as executors would not share what each has written.

    A checkpoint keeps its plan's estimate of size, which is a product over joins: in a
    loop that joins its own results the number has three times the digits each round,
    until the driver is busy with nothing else.  Estimates beyond Spark's own default
    for a size it does not know are given up for that default.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="tidemark-checkpoints-")
            atexit.register(shutil.rmtree, folder, True)
        sc.setCheckpointDir(folder)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        out = df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    plan = out._jdf.queryExecution()
    if plan.optimizedPlan().stats().sizeInBytes() < 2**63:
        return out
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(plan.toRdd(), out._jdf.schema(), False), spark)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files give work to a quarter of them at most, such as one file of one row group.

    Only small inputs are like that; others keep the partitions that their files give.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 4 * df.rdd.getNumPartitions() <= cores else df


def ship(spark: SparkSession) -> None:
    """Set what right results need, and send this package's modules and tables to the executors once per Spark context."""
    prepare(spark)
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = Path(__file__).parent
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*")):
            if p.suffix in (".py", ".txt"):
                z.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)
    sc._tidemark_shipped = True
