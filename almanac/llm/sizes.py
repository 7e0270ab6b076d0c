"""How many buckets an operator deals its input into."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

MIN_BUCKETS = 64


def buckets(df: DataFrame, bytes_each: int) -> int:
    """Buckets of about ``bytes_each`` stored bytes."""
    return max(MIN_BUCKETS, math.ceil(_stored(df) / bytes_each))


def _stored(df: DataFrame) -> int:
    """Bytes by the plan's size estimate (for file scans the file sizes; no job runs)."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.count() * 4096 if size > 1 << 55 else size  # an estimate through joins has no meaning any more


#: Input bytes for each partition of a grouped shuffle, and partitions at most; larger tables have larger ones, whose groups still come one at a time.
PARTITION_BYTES, MOST_PARTITIONS = 8 << 20, 100_000


def partitions(df: DataFrame) -> int:
    """Partitions of a shuffle by group that grow with the table, so that no task does."""
    return max(df.sparkSession.sparkContext.defaultParallelism, min(MOST_PARTITIONS, _stored(df) // PARTITION_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
