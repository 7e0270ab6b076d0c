"""One place that builds a SparkSession and finds the shared folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build(app: str = "almanac", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator relies on: UTC, adaptive execution, and checkpoints that go when they aren't used any more."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # a checkpoint goes when nothing refers to it any more
    }
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path may be local or any URI that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt over all cores where they come from fewer files than that; larger tables stay as they are, without a shuffle."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, *keys) if len(rows.inputFiles()) < cores else rows


def dealt(rows: DataFrame) -> DataFrame:
    """Few rows with much work each, over four tasks a core at least; adaptive execution would put them together by their bytes."""
    spark = rows.sparkSession
    return rows.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def once(rows: DataFrame, keys: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` with the columns that ``work`` adds to ``keys``, from which alone they follow: equal keys are worked through once.

    ``work`` is given the distinct keys and returns a row for each; where it leaves one out, its rows go. Nulls are a key like any other.
    """
    made = work(dealt(rows.select(*keys).distinct())).withColumnsRenamed({k: f"_once_{k}" for k in keys})
    met = [F.col(k).eqNullSafe(F.col(f"_once_{k}")) for k in keys]
    return rows.join(made, met).drop(*(f"_once_{k}" for k in keys))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one of spark.checkpoint.dir.

    Where that is unset a session on one machine takes a temporary folder; any other fails, since
    executors don't see the driver's disk.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint"))
    return sc._jsc.sc().getCheckpointDir().get()


def file_system(spark: SparkSession, path: str):
    """(file system, path) of any store that Spark reaches."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p
