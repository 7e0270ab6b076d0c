"""Watching by time: debounce and stalls told by timers."""

import datetime as dt
import time

import pytest
from almanac.streaming import rounds, watch
from pyspark.sql import functions as F

SCHEMA = "key string, fingerprint string, ts timestamp"


def at(m, s=0):
    return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=m, seconds=s)


def folder(spark, tmp_path, batches):
    for k, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    return spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True)


def drain(df, tmp_path, name):
    w = df.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True)
    q = watch.started(w, df.sparkSession)
    q.awaitTermination()
    return sorted(((r.key, r.value, r.since, r.told) for r in df.sparkSession.read.schema(watch.OUTPUT).parquet(str(tmp_path / name)).collect()), key=str), q


BATCHES = [
    [("d", "f1", at(0)), ("d", "f1", at(1)), ("quiet", "q", at(2))], [("d", "f1", at(6)), ("x", "1", at(9))], [("d", "f2", at(10)), ("d", "f1", at(11)), ("d", "f1", at(20))],
    [("d", "f3", at(30)), ("x", "2", at(36)), ("d", None, at(37)), ("n", None, at(37))], [("x", "3", at(60))],
]
WANT = [("d", None, at(37), at(42)), ("d", "f1", at(0), at(5)), ("d", "f3", at(30), at(35)), ("n", None, at(37), at(42)), ("quiet", "q", at(2), at(7)), ("x", "1", at(9), at(14)), ("x", "2", at(36), at(41))]


@pytest.mark.parametrize("per_batch", [1, 100])
def test_states_that_last_are_told_once_however_the_stream_is_cut(spark, tmp_path, per_batch):
    s = folder(spark, tmp_path, BATCHES).option("maxFilesPerTrigger", per_batch).parquet(str(tmp_path / "in"))
    got, _ = drain(watch.lasting(s, "key", "fingerprint", "ts", 300), tmp_path, "out")
    assert sorted(got, key=str) == sorted(WANT, key=str)  # f1 isn't told again at 16; the quiet key and the last ones by timers


def test_a_restart_goes_on_with_state_and_timers(spark, tmp_path):
    read = folder(spark, tmp_path, BATCHES[:2])
    df = lambda: watch.lasting(read.parquet(str(tmp_path / "in")), "key", "fingerprint", "ts", 300)
    first, _ = drain(df(), tmp_path, "out")
    assert [g[:2] for g in first] == [("d", "f1"), ("quiet", "q")]
    for k, b in enumerate(BATCHES[2:]):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/later{k}"))
    got, _ = drain(df(), tmp_path, "out")
    assert sorted(got, key=str) == sorted(WANT, key=str)


def test_the_watermark_alone_ends_a_last_state(spark, tmp_path):
    ms = lambda m, k: at(m) + dt.timedelta(milliseconds=k)
    rows = [("again", "a", at(4)), ("again", "a", ms(9, 500)), ("reached", "r", at(4)), ("beyond", "b", ms(4, 1)), ("last", "l", at(10))]
    got, _ = drain(watch.lasting(folder(spark, tmp_path, [rows]).parquet(str(tmp_path / "in")), "key", "fingerprint", "ts", 300, "1 minute"), tmp_path, "out")
    assert got == [("again", "a", at(4), at(9)), ("reached", "r", at(4), at(9))]  # the watermark is at 9: there to the millisecond
    rows = [("again", "a", at(5)), ("again", "a", at(10))]
    got, _ = drain(watch.lasting(folder(spark, tmp_path / "b", [rows]).parquet(str(tmp_path / "b/in")), "key", "fingerprint", "ts", 300, "1 minute"), tmp_path, "early")
    assert got == []  # five minutes of the same state, of which the watermark has seen four


def test_samples_of_one_time_go_by_their_order(spark, tmp_path):
    rows = [("k", v, at(m), n) for v, m, n in (("b", 0, 2), ("a", 0, 1), ("c", 10, 4), ("b", 10, 3), ("c", 20, 5), ("b", 30, 6))]
    spark.createDataFrame(rows, f"{SCHEMA}, n long").coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(f"{SCHEMA}, n long").parquet(str(tmp_path / "in"))
    got, _ = drain(watch.lasting(s, "key", "fingerprint", "ts", 300, order="n"), tmp_path, "out")
    assert got == [("k", "b", at(0), at(5)), ("k", "c", at(10), at(15))]


def test_a_stall_is_told_while_nothing_arrives(spark, tmp_path):
    s = folder(spark, tmp_path, [[("download", "1000 bytes", at(0))]]).parquet(str(tmp_path / "in"))
    w = watch.lasting(s, "key", "fingerprint", "ts", 2, by_clock=True, forget=dt.timedelta(hours=1)).writeStream.format("memory").queryName("stalls").option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="1 second")
    q = watch.started(w, spark)
    try:
        until = time.time() + 60
        while time.time() < until and spark.table("stalls").isEmpty():
            time.sleep(1)
        assert [(r.key, r.value) for r in spark.table("stalls").collect()] == [("download", "1000 bytes")]
    finally:
        q.stop()
    with pytest.raises(ValueError):
        watch.lasting(s, "key", "fingerprint", "ts", 2, forget=dt.timedelta(hours=1))


def test_streamed_rounds_are_exact_and_late_rows_counted(spark, tmp_path):
    schema = "user_id long, ts timestamp, value double"
    day = lambda d, h=0: dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h)
    batches = [[(u % 7, day(0, 13 + u % 5), 1.5) for u in range(40)], [(3, day(3), 1.0), (99, day(9), 1.0)], [(99, day(9, 1), 0.0)], [(1, day(2), 5.0), (2, day(9), 1.0)], [(5, day(20), 1.0)], [(5, day(40), 1.0)], [(5, day(41), 1.0)]]
    for k, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    s = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = rounds.weekly_rounds(s, "1 hour").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.round_start, r.n, r.n_users, r.value) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got[0] == (day(0, 12), 41, 7, 61.0) and got[1] == (day(7, 12), 3, 2, 2.0)
    assert rounds.late_rows([p if isinstance(p, dict) else __import__("json").loads(p.json) for p in q.recentProgress]) == 1


def test_mixed_stream_numbers_a_large_batch_in_order(spark, tmp_path):
    rows = spark.range(25_000).select(F.lit("a").alias("source"), ((F.col("id") * 7919) % 25_000).alias("pos"))
    rows.repartition(5).write.parquet(str(tmp_path / "in"))
    s = rounds.mixed_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), 10)
    q = s.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 25_000 and out.where("kept <> pos OR turn <> pos div 10").isEmpty()
