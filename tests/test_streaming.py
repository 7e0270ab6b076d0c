import datetime as dt

from almanac.streaming import rounds
from pyspark.sql import functions as F


def drained(df, tmp_path, name):
    q = df.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(str(tmp_path / name))


def test_rounds_begin_on_monday_noon(spark):
    rows = spark.sql("SELECT explode(sequence(TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP'2024-01-20 00:00:00', INTERVAL 6 HOURS)) AS ts").select("ts", F.lit(1).alias("user_id"), F.lit(1.0).alias("value"))
    got = sorted(r.round_start for r in rounds.weekly_rounds(rows).collect())
    assert got == [dt.datetime(2023, 12, 25, 12), dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 8, 12), dt.datetime(2024, 1, 15, 12)]


def test_late_submissions_are_ignored_by_a_stream(spark, tmp_path):
    at = lambda s: dt.datetime.fromisoformat(s)
    batches = [[(1, at("2024-01-08 11:00"), 1.0)], [(2, at("2024-01-08 14:00"), 1.0)], [(7, at("2024-01-08 14:10"), 1.0)], [(3, at("2024-01-08 11:30"), 1.0), (4, at("2024-01-08 13:30"), 1.0)], [(5, at("2024-01-16 00:00"), 1.0)], [(6, at("2024-01-16 01:00"), 1.0)]]
    for k, b in enumerate(batches):
        spark.createDataFrame(b, "user_id long, ts timestamp, value double").coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{k}"))
    s = spark.readStream.schema("user_id long, ts timestamp, value double").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    got = {(r.round_start.isoformat(), r.n) for r in drained(rounds.weekly_rounds(s, "1 hour"), tmp_path, "out").collect()}
    assert ("2024-01-01T12:00:00", 1) in got  # user 3 came over an hour after the round had ended


def test_capped_stream_equals_the_batch_and_resumes(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet")
    e.where("event_id < 500").write.parquet(str(tmp_path / "in/a"))
    s = lambda: rounds.capped_stream(spark.readStream.schema(e.schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in")), 1)
    drained(s(), tmp_path, "out")
    e.where("event_id >= 500").write.parquet(str(tmp_path / "in/b"))
    got = {r.event_id for r in drained(s(), tmp_path, "out").where("accepted").collect()}
    assert got == {r.event_id for r in rounds.capped(e, 1).collect()}


def test_mixed_stream_keeps_counting_after_a_restart(spark, tmp_path):
    rows = spark.range(20).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"), F.col("id").alias("pos"))
    rows.where("pos < 10").write.parquet(str(tmp_path / "in/a"))
    s = lambda: rounds.mixed_stream(spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in")), 4)
    drained(s(), tmp_path, "out")
    rows.where("pos >= 10").write.parquet(str(tmp_path / "in/b"))
    got = {(r.source, r.pos): (r.kept, r.turn) for r in drained(s(), tmp_path, "out").collect()}
    assert got == {("ab"[p % 2], p): (p // 2, p // 8) for p in range(20)}


def test_once_per_batch(spark, tmp_path):
    seen = []
    f = rounds.once_per_batch(lambda b, k: seen.append(b.count()), str(tmp_path / "ledger"))
    for k in (0, 0, 1, 0):
        f(spark.range(3), k)
    assert seen == [3, 3]


def test_stability_and_stalls(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = spark.createDataFrame([("r", t(0), 1), ("r", t(1), 2), ("r", t(3), 2), ("r", t(9), 2), ("r", t(10), 3)], "k string, ts timestamp, size int")
    got = [(r.size, r.seconds, r.stable) for r in rounds.stable_spans(rows, "k", "size", "ts", 300).orderBy("first").collect()]
    assert got == [(1, 0.0, False), (2, 480.0, True), (3, 0.0, False)]
    assert [r.size for r in rounds.stalls(rows, "k", "size", "ts", 300).collect()] == [2]
