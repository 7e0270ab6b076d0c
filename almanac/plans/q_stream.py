"""Queries of rounds, rate caps, stability and budgets; the streaming forms run to the end of what is there."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import shared_folder, table
from ..streaming import rounds, watch
from .registry import query


@query("""SELECT epoch_us(date_trunc('week', ts - INTERVAL 12 HOUR) + INTERVAL 12 HOUR) AS round_start, count(*) AS n, count(DISTINCT user_id) AS n_users, round(sum(value), 2) AS value FROM events GROUP BY 1""")
def weekly_rounds(spark, sf_dir):
    """Rounds from Monday 12:00 UTC."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rounds.weekly_rounds(e).select(F.unix_micros("round_start").alias("round_start"), "n", "n_users", F.round("value", 2).alias("value"))


@query("SELECT event_id, user_id, attempt FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS attempt FROM events) WHERE attempt <= 2")
def daily_cap(spark, sf_dir):
    return rounds.capped(table(spark, sf_dir, "events"), 2).select("event_id", "user_id", F.col("attempt").cast("long").alias("attempt"))


@query("""WITH c AS (SELECT event_id, user_id, event_type, ts, CAST(coalesce(event_type <> lag(event_type) OVER w, true) AS INTEGER) AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT user_id, event_type, round(epoch_us(min(ts)) / 1e6, 3) AS first, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS seconds, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 >= 3600 AS stable FROM r GROUP BY user_id, event_type, run""")
def stable_spans(spark, sf_dir):
    """Runs of an unchanged state per user (gaps and islands)."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = rounds.stable_spans(e, "user_id", "event_type", "ts", 3600)
    return s.select("user_id", "event_type", F.round(F.unix_micros("first") / 1e6, 3).alias("first"), F.round("seconds", 3).alias("seconds"), "stable")


@query("""WITH w AS (SELECT event_id, coalesce(sum(2 + event_id % 2) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM events)
SELECT event_id, CAST(spent AS BIGINT) AS spent, NOT spent <= 10 AS skipped FROM w""")
def time_budget(spark, sf_dir):
    """Work of two or three seconds with a budget of ten; work that begins exactly then is still done."""
    work = table(spark, sf_dir, "events").select("event_id", "user_id", (2 + F.col("event_id") % 2).alias("seconds"))
    return rounds.within_budget(work, "user_id", "event_id", "seconds", 10).select("event_id", F.col("spent").cast("long").alias("spent"), "skipped")


@query("""SELECT event_id, min(value) OVER w AS best, coalesce(value < min(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS improved
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def running_best(spark, sf_dir):
    return rounds.running_best(table(spark, sf_dir, "events"), "user_id", "event_id", "value").select("event_id", "best", "improved")


@query("""SELECT user_id, CAST(floor(event_id / 500) AS BIGINT) AS point, round(avg(value), 6) AS loss, count(*) AS n, round(count(*) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0), 9) AS per_second FROM events GROUP BY 1, 2""")
def interval_metrics(spark, sf_dir):
    """Mean loss, count and rate between log points."""
    m = rounds.interval_metrics(table(spark, sf_dir, "events"), ["user_id"], "event_id", "ts", "value", 500)
    return m.withColumns({"loss": F.round("loss", 6), "per_second": F.round("per_second", 9)})


def _drain(spark, build, sf_dir, schema):
    """Run a stream over the events file to its end into the shared folder, and read it back."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    source = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    writer = build(source).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True)
    watch.started(writer, spark).awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/out")


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS attempt, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) <= 2 AS accepted FROM events")
def stream_daily_cap(spark, sf_dir):
    """The cap as a stateful stream: every attempt numbered, those beyond the cap marked."""
    return _drain(spark, lambda s: rounds.capped_stream(s, 2), sf_dir, "event_id long, user_id long, attempt long, accepted boolean")


@query("""WITH c AS (SELECT user_id, event_type, ts, coalesce(event_type <> lag(event_type) OVER w, true) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, event_type, ts AS since, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until FROM c WHERE new),
l AS (SELECT * FROM s WHERE since + INTERVAL 1 HOUR <= coalesce(until, (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE)),
t AS (SELECT *, coalesce(event_type <> lag(event_type) OVER (PARTITION BY user_id ORDER BY since), true) AS told FROM l)
SELECT CAST(user_id AS STRING) AS key, event_type AS value, epoch_us(since) AS since, epoch_us(since + INTERVAL 1 HOUR) AS told FROM t WHERE told""")
def watched_states(spark, sf_dir):
    """States of users that lasted an hour, told by timers of a stream, those behind the last sample of a user too."""
    def build(s):
        return watch.lasting(s.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "event_type", "ts", 3600, "1 minute", order="event_id")

    told = _drain(spark, build, sf_dir, watch.OUTPUT)
    return told.select("key", "value", F.unix_micros("since").alias("since"), F.unix_micros("told").alias("told"))


@query("""WITH r AS (SELECT date_trunc('week', ts - INTERVAL 12 HOUR) + INTERVAL 12 HOUR AS start, user_id, value FROM events)
SELECT epoch_us(start) AS round_start, count(*) AS n, count(DISTINCT user_id) AS n_users, round(sum(value), 2) AS value FROM r WHERE start + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY start""")
def stream_rounds(spark, sf_dir):
    """Closed rounds of a stream with exact distinct users; a round closes a day after its end."""
    closed = _drain(spark, lambda s: rounds.weekly_rounds(s.withColumn("ts", F.col("ts").cast("timestamp")), "1 day"), sf_dir, "round_start timestamp, n long, n_users long, value double")
    return closed.select(F.unix_micros("round_start").alias("round_start"), "n", "n_users", F.round("value", 2).alias("value"))
