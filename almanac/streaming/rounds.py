"""Structured Streaming: weekly rounds, late data, rate caps, stability, once-only processing, resumable mixing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from ..session import file_system


#: Length, step and begin of rounds.
ROUND = ("7 days", "7 days", "4 days 12 hours")


def round_window(ts: Column) -> Column:
    """Weeks from Monday 12:00 UTC (the epoch was a Thursday)."""
    return F.window(ts, *ROUND)


def weekly_rounds(events: DataFrame, grace: str | None = None) -> DataFrame:
    """(round_start, n, n_users, value) per week, with exact distinct users. ``grace`` is how late a submission may come.

    A stream has two stateful operators, one behind the other: one row per round and user, given
    out when the round closes, and the rounds over these. Rows that come after their
    round closed are dropped and counted (``late_rows``).
    """
    rows = events.withWatermark("ts", grace) if grace else events
    if not rows.isStreaming:
        counted = rows.groupBy(round_window(F.col("ts")).alias("w")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"), F.sum("value").alias("value"))
        return counted.select(F.col("w.start").alias("round_start"), "n", "n_users", "value")
    users = rows.groupBy(round_window(F.col("ts")), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    counted = users.groupBy(F.window(F.window_time("window"), *ROUND).alias("w")).agg(F.sum("n").alias("n"), F.count("user_id").alias("n_users"), F.sum("value").alias("value"))
    return counted.select(F.col("w.start").alias("round_start"), "n", "n_users", "value")


def late_rows(progress: list[dict]) -> int:
    """How many rows a stream dropped because they came after their time, by the progress of its batches."""
    return sum(int(o.get("numRowsDroppedByWatermark", 0)) for p in progress for o in p.get("stateOperators", []))


def capped(events: DataFrame, cap: int = 12, key: str = "user_id", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """The first ``cap`` rows of each key and day (batch)."""
    n = F.row_number().over(Window.partitionBy(key, F.to_date(ts)).orderBy(ts, tie))
    return events.withColumn("attempt", n).where(F.col("attempt") <= cap)


#: Days of counts that a key keeps behind its latest day; a row that comes later still is late and rejected.
KEPT_DAYS = 31


def capped_stream(events: DataFrame, cap: int = 12) -> DataFrame:
    """The same over a stream of (event_id, ts, user_id): counts by day for each key in the state store; rejects are marked, as a client sees them.

    A key's rows of one micro-batch are ordered together. Rows of days that the state no longer
    has are rejected without a number, so the cap can't be passed twice.
    """
    rows = events.select("event_id", "ts", "user_id", F.unix_date(F.to_date("ts")).alias("day"))

    def count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        counts = dict(zip(*state.get, strict=True)) if state.exists else {}
        b = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        late = b["day"] < max(counts) - KEPT_DAYS if counts else pd.Series(False, index=b.index)
        for rows, known in ((b[~late], True), (b[late], False)):
            if len(rows):
                attempt = rows.groupby("day").cumcount() + 1 + rows["day"].map(counts).fillna(0).astype("int64")
                if known:
                    counts |= attempt.groupby(rows["day"]).max().to_dict()
                yield pd.DataFrame({"event_id": rows["event_id"], "user_id": rows["user_id"], "attempt": attempt if known else None, "accepted": attempt <= cap if known else False})
        days = sorted(d for d in counts if d >= max(counts) - KEPT_DAYS)
        state.update(([int(d) for d in days], [int(counts[d]) for d in days]))

    return rows.groupBy("user_id").applyInPandasWithState(count, "event_id long, user_id long, attempt long, accepted boolean", "days array<int>, counts array<long>", "append", GroupStateTimeout.NoTimeout)


def stable_spans(samples: DataFrame, key: str, value: str, ts: str, at_least_seconds: float) -> DataFrame:
    """(key, value, first, last, seconds, stable): runs of an unchanged fingerprint, and whether one lasted long enough."""
    w = Window.partitionBy(key).orderBy(ts)
    changed = (~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int")
    runs = samples.withColumn("_c", changed).withColumn("_run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy(key, "_run", value).agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
    seconds = F.unix_micros(F.col("last").cast("timestamp")) / 1e6 - F.unix_micros(F.col("first").cast("timestamp")) / 1e6
    return spans.select(key, value, "first", "last", seconds.alias("seconds")).withColumn("stable", F.col("seconds") >= at_least_seconds)


def stalls(samples: DataFrame, key: str, size: str, ts: str, seconds: float) -> DataFrame:
    """Runs without growth of at least ``seconds``."""
    return stable_spans(samples, key, size, ts, seconds).where("stable")


def within_budget(work: DataFrame, key: str, order: str, duration: str, budget: float) -> DataFrame:
    """Work items of a key that begin while no more than its budget is spent; the rest is skipped."""
    before = F.coalesce(F.sum(duration).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return work.withColumn("spent", before).withColumn("skipped", F.col("spent") > budget)


def running_best(logs: DataFrame, key: str, order: str, loss: str) -> DataFrame:
    """The least loss so far and whether a row improves on it."""
    w = Window.partitionBy(key).orderBy(order)
    before = F.min(loss).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return logs.withColumn("best", F.min(loss).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("improved", before.isNull() | (F.col(loss) < before))


def batch_folder(folder: str) -> Callable[[DataFrame, int], None]:
    """A sink that gives every micro-batch a folder of its own, so that a batch done again replaces what it wrote before."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def once_per_batch(process: Callable[[DataFrame, int], None], ledger: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that skips batches in the ledger (a Parquet folder).

    A crash between the work and its entry repeats the work, so ``process`` gets the batch's
    number and must be idempotent by it, as ``batch_folder`` is; then every batch counts once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fs, path = file_system(spark, ledger)
        if fs.exists(path) and not spark.read.parquet(ledger).where(F.col("batch_id") == batch_id).isEmpty():
            return
        process(batch, batch_id)
        spark.createDataFrame([(batch_id,)], "batch_id long").write.mode("append").parquet(ledger)

    return run


def mixed_stream(rows: DataFrame, docs_per_turn: int) -> DataFrame:
    """Turns over a stream of (source, pos, text): how many documents each source has given is kept in the state store, so a restart resumes."""

    def turn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        b = pd.concat([x[["source", "pos"]] for x in batches]).sort_values("pos")  # all of a micro-batch: its Arrow batches come in any order
        k = np.arange(n, n + len(b))
        state.update((n + len(b),))
        yield pd.DataFrame({"source": b["source"], "pos": b["pos"], "kept": k, "turn": k // docs_per_turn})

    return rows.select("source", "pos").groupBy("source").applyInPandasWithState(turn, "source string, pos long, kept long, turn long", "n long", "append", GroupStateTimeout.NoTimeout)


def interval_metrics(steps: DataFrame, keys: list[str], order: str, ts: str, value: str, every: int) -> DataFrame:
    """(…keys, point, loss, n, per_second): the mean between log points ``every`` steps apart, and steps by second (NULL in no time)."""
    seconds = (F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / 1e6
    points = steps.groupBy(*keys, F.floor(F.col(order) / every).alias("point"))
    return points.agg(F.avg(value).alias("loss"), F.count("*").alias("n"), F.try_divide(F.count("*"), seconds).alias("per_second"))
