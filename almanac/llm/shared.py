"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import file_system, shared_folder

#: Spark removes an action's shuffle files when the action ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept by ``checkpoint()`` in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def freed(df: DataFrame) -> DataFrame:
    """``cut`` whose shuffle files go as soon as it is written, not when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return cut(df.select("*"))  # the setting holds for plans that are made under it
    finally:
        conf.set(CLEANUP, before)


def released(spark: SparkSession) -> None:
    """Working files of earlier results that nothing refers to any more go now, not when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def passing(spark: SparkSession, folder: str) -> Iterator[None]:
    """Shuffle files of actions meanwhile go when the action ends; checkpoints lie below ``folder``, which goes at the end."""
    sc, above, before = spark.sparkContext, shared_folder(spark).rsplit("/", 1)[0], spark.conf.get(CLEANUP, "false")
    sc.setCheckpointDir(folder)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)
        sc.setCheckpointDir(above)
        remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches."""
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written whole."""
    fs, mark = file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(mark)
