"""Writers: atomic JSON lines, results, reports and the outbox."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import file_system
from .store import ResultStore


def write_jsonl(rows: DataFrame, path: str, order: Column | None = None) -> None:
    """JSON lines; Spark's committer makes the folder appear whole or not at all."""
    (rows.orderBy(order) if order is not None else rows).write.mode("overwrite").json(path)


def swap_in(rows: DataFrame, path: str, column_check: Callable[[DataFrame], None] | None = None) -> None:
    """Rewrite a JSON folder from itself: write beside it, check, move the old one aside, rename, then drop the old one."""
    spark, side = rows.sparkSession, f"{path}.next"
    rows.write.mode("overwrite").json(side)
    if column_check:
        column_check(spark.read.json(side))
    fs, target = file_system(spark, path)
    _, source = file_system(spark, side)
    _, before = file_system(spark, f"{path}.before")
    fs.delete(before, True)
    if fs.exists(target):
        fs.rename(target, before)  # until the new one is in place the old one is there, under one name or the other
    fs.rename(source, target)
    fs.delete(before, True)


def as_result(rows: DataFrame, *keys: str) -> DataFrame:
    """(…keys, result): the other columns as one JSON object a row."""
    return rows.select(*keys, F.to_json(F.struct(*[c for c in rows.columns if c not in keys])).alias("result"))


def rank_report(rows: DataFrame) -> DataFrame:
    """Lines of a ranking table: place, uid, score."""
    return rows.select(F.format_string("%3d  uid %6d  %8.4f", F.col("rank"), F.col("uid"), F.col("score")).alias("line"))


def category_report(stats: DataFrame) -> DataFrame:
    """Lines of a duel by category: category, prompts, wins of both, ties."""
    return stats.select(F.format_string("%-24s %4d %12d %12d %6d", F.coalesce("category", F.lit("unknown")), F.col("n"), F.col("wins_a"), F.col("wins_b"), F.col("ties")).alias("line"))


def sync_outbox(pending: DataFrame, send: Callable[[DataFrame], DataFrame], key: str = "key") -> DataFrame:
    """Push rows that aren't synced and mark those whose key ``send`` gives back; a lost answer leaves a row for the next try."""
    acked = send(pending.where(~F.col("synced"))).select(F.col(key).alias("_acked")).distinct()
    return pending.join(acked, F.col(key) == F.col("_acked"), "left").withColumn("synced", F.col("synced") | F.col("_acked").isNotNull()).drop("_acked")


def outbox_batches(send: Callable[[DataFrame], DataFrame], store: ResultStore, name: str, key: str = "key") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: a batch's rows enter the stored outbox, then all that wait are sent and the acknowledged ones marked.

    Rows are sent at least once: those of a batch that is done again, or without an answer, wait for the next one.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        store.insert_ignore(name, batch.withColumn("synced", F.lit(False)))
        waiting = store.read(name).where(~F.col("synced"))
        if not waiting.isEmpty():
            store.upsert(name, sync_outbox(waiting, send, key).where("synced"))

    return run
