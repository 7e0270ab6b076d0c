"""Queries of sinks, retries, work that counts once, stalls and validations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.dates import snapshot_year
from ..operators import corpus
from ..session import shared_folder, table
from ..sources import sinks, store
from ..streaming import rounds
from .registry import query
from .views import view


@query("""WITH c AS (SELECT user_id, CAST(floor(value / 20) AS BIGINT) AS size, ts, event_id FROM events),
k AS (SELECT *, CAST(coalesce(size <> lag(size) OVER (PARTITION BY user_id ORDER BY ts), true) AS INTEGER) AS new FROM c),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM k)
SELECT user_id, size, epoch_us(min(ts)) AS first, epoch_us(max(ts)) AS last FROM r GROUP BY user_id, size, run HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= 7200000000""")
def stall_spans(spark, sf_dir):
    """Downloads whose size did not change for two hours."""
    e = table(spark, sf_dir, "events").select("user_id", F.floor(F.col("value") / 20).alias("size"), F.col("ts").cast("timestamp").alias("ts"))
    return rounds.stalls(e, "user_id", "size", "ts", 7200).select("user_id", "size", F.unix_micros("first").alias("first"), F.unix_micros("last").alias("last"))


@query("SELECT event_id, user_id, CASE WHEN event_id % 5 = 0 THEN value + 1 ELSE value END AS value, event_id % 5 = 0 AS changed FROM events WHERE event_id % 9 <> 0")
def rewritten_lines(spark, sf_dir):
    """Events as JSON lines, then rewritten in place: some changed, some gone."""
    folder = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    sinks.write_jsonl(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), folder, F.col("event_id"))
    old = spark.read.schema("event_id long, user_id long, value double").json(folder)
    hit = F.col("event_id") % 5 == 0
    sinks.swap_in(old.where("event_id % 9 <> 0").select("event_id", "user_id", F.when(hit, F.col("value") + 1).otherwise(F.col("value")).alias("value"), hit.alias("changed")), folder)
    return spark.read.schema("event_id long, user_id long, value double, changed boolean").json(folder)


@query("SELECT event_id AS key, event_type AS body, event_id % 4 <> 3 AS synced FROM events")
def outbox_retries(spark, sf_dir):
    """Three batches into an outbox, the first one twice; the receiver acknowledges some rows only at their second try and some never."""
    s = store.ResultStore(spark, f"{shared_folder(spark)}/outbox-{uuid.uuid4().hex}", {"outbox": ("key long, body string, synced boolean", ["key"])})
    s.create()
    tries = []

    def send(waiting):
        tries.append(1)
        return waiting.where(F.col("key") % 4 != 3 if len(tries) > 3 else F.col("key") % 4 == 0)

    run = sinks.outbox_batches(send, s, "outbox")
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("key"), F.col("event_type").alias("body"))
    for k in (0, 0, 1, 2):
        run(e.where(F.col("key") % 3 == k), k)
    return s.read("outbox")


@query("SELECT event_id % 4 AS batch, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1")
def batches_once(spark, sf_dir):
    """Four batches, some of them done again as after a crash; each counts once."""
    folder = f"{shared_folder(spark)}/once-{uuid.uuid4().hex}"
    run = rounds.once_per_batch(rounds.batch_folder(f"{folder}/out"), f"{folder}/ledger")
    e = table(spark, sf_dir, "events").select("event_id", "value")
    for k in (0, 1, 1, 0, 2, 3, 2):
        run(e.where(F.col("event_id") % 4 == k), k)
    return spark.read.parquet(f"{folder}/out").groupBy(F.col("batch_id").cast("long").alias("batch")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))


@query("""WITH s AS (SELECT DISTINCT snapshot, CAST(substring(snapshot, 1, 4) AS INTEGER) AS y FROM crawl_docs), k AS (SELECT CAST(c AS INTEGER) AS cutoff FROM range(2013, 2023) AS t(c))
SELECT cutoff, (SELECT count(*) FROM s WHERE y <= cutoff) AS snapshots, (SELECT max(y) FROM s) <= cutoff AS all_in_time FROM k""", ("crawl_docs",))
def snapshot_cutoffs(spark, sf_dir):
    """Whether the table's snapshots pass each cutoff's validation, and how many are left under it."""
    names = view(spark, sf_dir, "crawl_docs").select("snapshot").distinct().cache()

    def passes(cutoff):
        try:
            corpus.check_snapshot(names, cutoff)
            return True
        except corpus.CutoffError:
            return False

    told = spark.createDataFrame([(k, passes(k)) for k in range(2013, 2023)], "cutoff int, all_in_time boolean")
    years = names.select(snapshot_year(F.col("snapshot")).alias("y"))
    n = years.groupBy("y").count().collect()  # a row a year
    left = {k: sum(r["count"] for r in n if r.y <= k) for k in range(2013, 2023)}
    return told.withColumn("snapshots", F.create_map(*(F.lit(x) for p in left.items() for x in p))[F.col("cutoff")].cast("long")).select("cutoff", "snapshots", "all_in_time")
