"""Stored tables, benchmark folders, counters, the outbox and the watcher."""

import datetime as dt
import json

import pytest
from almanac.operators import duplicates, rank
from almanac.sources import sinks, store, text_files
from almanac.streaming import rounds
from pyspark.sql import functions as F


def test_tables_hold_their_keys(spark, tmp_path):
    s = store.result_store(spark, str(tmp_path / "r"))
    assert s.read("svd_spectra").count() == 0 and not s.has("eval_runs", week=3)
    s.insert_ignore("eval_runs", spark.createDataFrame([(3,), (3,), (4,)], "week long"))
    s.insert_ignore("eval_runs", spark.createDataFrame([(3,)], "week long"))
    assert s.read("eval_runs").count() == 2 and s.has("eval_runs", week=3)
    rows = spark.createDataFrame([(1, 2020, 7, 0.5, True)], "uid long, year int, round int, score double, synced boolean")
    s.upsert("evaluations", rows)
    s.upsert("evaluations", rows.withColumns({"score": F.lit(0.9), "synced": F.lit(False)}))
    assert [(r.score, r.synced) for r in s.read("evaluations").collect()] == [(0.9, False)]
    s.delete("evaluations", "uid = 1 AND score > 0.7")
    assert s.read("evaluations").count() == 0
    with pytest.raises(Exception, match="week is NULL"):
        s.upsert("eval_runs", spark.createDataFrame([(None,)], "week long"))
    assert s.read("eval_runs").count() == 2  # a failed write leaves the table as it was
    again = store.result_store(spark, str(tmp_path / "r"))
    assert again.read("eval_runs").count() == 2
    with pytest.raises(FileNotFoundError):
        store.ResultStore(spark, str(tmp_path / "none"), store.TABLES).read("eval_runs")


def test_prompts_and_completions_keep_their_json(spark, tmp_path):
    s = store.result_store(spark, str(tmp_path / "r"))
    prompts = [{"prompt": "why?", "category": "x"}, {"prompt": "é \"quoted\""}]
    s.upsert("quality_prompts", spark.createDataFrame([(5, json.dumps(prompts))], "round int, prompts_json string"))
    assert json.loads(s.read("quality_prompts").where("round = 5").first().prompts_json) == prompts
    c = spark.createDataFrame([(5, 2020, 1, '["a"]'), (5, 2021, 1, '["b"]')], "round int, year int, uid long, completions_json string")
    s.upsert("quality_completions", c)
    s.upsert("quality_completions", c.where("year = 2020").withColumn("completions_json", F.lit('["c"]')))
    assert {(r.year, r.completions_json) for r in s.read("quality_completions").collect()} == {(2020, '["c"]'), (2021, '["b"]')}


def test_benchmark_folder(spark, tmp_path):
    for y in (2012, 2013):
        (tmp_path / str(y)).mkdir()
        for kind, year in (("known", y), ("unknown", y + 1)):
            (tmp_path / str(y) / f"{kind}.json").write_text(json.dumps({"year": y, "items": [{"prompt": f"p{y}", "phrase": "x", "year": year, "weight": 5}, {"prompt": "q", "phrase": "y", "year": year}]}))
    got = text_files.benchmark_folder(spark, str(tmp_path), [2012, 2013]).collect()
    assert {(r.year, r.kind, r.fact_year) for r in got} == {(2012, "known", 2012), (2012, "unknown", 2013), (2013, "known", 2013), (2013, "unknown", 2014)} and sorted({r.weight for r in got}) == [1, 5]
    (tmp_path / "2013" / "known.json").write_text('{"items": []}')
    with pytest.raises(ValueError, match="2013"):
        text_files.benchmark_folder(spark, str(tmp_path), [2012, 2013])
    with pytest.raises(FileNotFoundError):
        text_files.benchmark_folder(spark, str(tmp_path), [2014])
    facts = spark.createDataFrame([("p", "f", y) for y in (2012, 2013)], "prompt string, phrase string, year int")
    with pytest.raises(ValueError):
        rank.benchmarks(facts, [2012, 2013])


def test_counters_are_seen_on_the_way(spark):
    lines = spark.createDataFrame([('{"a": 1}',), ("{broken",), ("  ",), (None,), ('{"a": 3}',)], "value string")
    rows = text_files.parsed_lines(lines, "a long")
    kept, seen = text_files.counted(rows, F.col("_state"), total=F.sum("a"))
    assert sorted(r.a for r in kept.collect()) == [1, 3]
    assert seen.get == {"scanned": 5, "kept": 2, "bad": 1, "blank": 2, "skipped": 0, "total": 4}


def test_outbox_sends_what_waits_until_it_is_acknowledged(spark, tmp_path):
    s = store.ResultStore(spark, str(tmp_path / "o"), {"outbox": ("key long, body string, synced boolean", ["key"])})
    s.create()
    sent = []

    def send(rows):
        keys = sorted(r.key for r in rows.collect())
        sent.append(keys)
        return rows.where("key <> 2" if len(sent) < 3 else "true")

    f = sinks.outbox_batches(send, s, "outbox")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "key long, body string")
    f(a, 0)
    f(a, 0)  # a batch done again
    f(spark.createDataFrame([(3, "z")], "key long, body string"), 1)
    assert sent == [[1, 2], [2], [2, 3]] and s.read("outbox").where("synced").count() == 3


def test_a_batch_folder_replaces_what_a_crash_left(spark, tmp_path):
    f = rounds.once_per_batch(rounds.batch_folder(str(tmp_path / "out")), str(tmp_path / "ledger"))
    spark.range(5).write.parquet(str(tmp_path / "out/batch_id=0"))  # work without its entry in the ledger
    f(spark.range(3), 0)
    f(spark.range(9), 0)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_any_of_three_tests_rejects(spark):
    base = [3.0, 1.0, 0.5, 0.2]
    rows = [(1, 1, 0, base), (2, 2, 0, [x * 2 for x in base]), (3, 3, 0, [-x for x in base]), (4, 4, 0, [0.1, 3.0, -2.0, 1.0])]
    layers = spark.createDataFrame(rows, "uid long, ord long, layer long, vec array<double>")
    logits = layers.select("uid", "ord", F.lit("k").alias("probe_type"), F.col("layer").alias("probe_idx"), F.col("vec").alias("logits"))
    got = {r.uid: (r.accepted, r.matched) for r in duplicates.greedy_any_test(layers, logits, output=0.0).collect()}
    assert got[1] == (True, None) and got[2] == (False, 1) and not got[4][0]  # a spectrum's first value alone is always 1
    apart = {r.uid: r.accepted for r in duplicates.greedy_any_test(layers, logits, spectrum=0.0, output=0.0).collect()}
    assert apart == {1: True, 2: False, 3: True, 4: True}
    alike = {r.uid: r.accepted for r in duplicates.greedy_any_test(layers, logits, spectrum=0.0, weight=2.0, output=100.0).collect()}
    assert alike == {1: True, 2: False, 3: False, 4: False}


def test_pairs_are_compared_once(spark):
    layers = spark.createDataFrame([(u, u, 0, [float(u), 1.0, 2.0]) for u in range(1, 4)], "uid long, ord long, layer long, vec array<double>")
    logits = layers.select("uid", "ord", F.lit("k").alias("probe_type"), F.col("layer").alias("probe_idx"), F.col("vec").alias("logits"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan(duplicates.greedy_any_test(layers, logits))


def test_undecided_candidates_are_an_error(spark):
    c = spark.createDataFrame([(1,), (2,), (3,)], "uid long")
    d = spark.createDataFrame([(2, 1), (3, 2)], "uid long, earlier long")
    with pytest.raises(RuntimeError):
        duplicates.greedy(c, d, most_rounds=1)


def test_late_rows_are_rejected_and_not_counted_anew(spark, tmp_path):
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    for k, rows in enumerate([[(1, day(0), 7), (2, day(0), 7)], [(3, day(60), 7)], [(4, day(0), 7), (5, day(60), 7)]]):
        spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long").coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    s = spark.readStream.schema("event_id long, ts timestamp, user_id long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = rounds.capped_stream(s, 2).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.event_id: (r.attempt, r.accepted) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: (1, True), 2: (2, True), 3: (1, True), 4: (None, False), 5: (2, True)}


def test_a_small_upsert_touches_few_buckets_and_old_commits_go(spark, tmp_path):
    s = store.ResultStore(spark, str(tmp_path / "b"), {"t": ("k long, v long", ["k"], "v")}, buckets=64)
    s.create()
    s.upsert("t", spark.range(2000).select(F.col("id").alias("k"), F.lit(0).alias("v")))
    before = s._latest("t")[1]["at"]
    written = s.upsert("t", spark.range(10).select((F.col("id") * 7).alias("k"), F.lit(5).alias("v")))
    after = s._latest("t")[1]["at"]
    assert len(before) == 64 and 0 < len(written) <= 10 and {b for b in before if before[b] != after[b]} == set(map(str, written))
    assert s.read("t").where("v = 5").count() == 10 and s.read("t").count() == 2000
    assert s.delete("t", "k > 5000") == [] and len(s.delete("t", "k = 3")) == 1 and s.read("t").count() == 1999
    for v in range(store.KEPT + 3):
        s.upsert("t", spark.createDataFrame([(1, v)], "k long, v long"))
    assert len(s._commits("t")) == store.KEPT and s.read("t").where("k = 1").first().v == store.KEPT + 2
    named = {p.split("/")[1] for c in s._commits("t") for p in s._manifest("t", c)["at"].values()}
    on_disk = {f.name for f in (tmp_path / "b" / "t" / "data").iterdir() if any(f.iterdir())}
    assert all(any((tmp_path / "b" / "t" / p).iterdir()) for p in s._latest("t")[1]["at"].values()) and named <= on_disk


def test_the_last_of_rows_with_one_key_wins(spark, tmp_path):
    s = store.ResultStore(spark, str(tmp_path / "v"), {"t": ("k long, v long, at long", ["k"], "at"), "u": ("k long, v long", ["k"])})
    s.create()
    rows = spark.createDataFrame([(1, 9, 1), (1, 3, 2), (2, 4, None), (2, 1, 0)], "k long, v long, at long").repartition(3)
    s.upsert("t", rows)
    s.upsert("u", rows)
    assert {(r.k, r.v) for r in s.read("t").collect()} == {(1, 3), (2, 1)} and {(r.k, r.v) for r in s.read("u").collect()} == {(1, 9), (2, 4)}


def test_two_writers_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    s = store.ResultStore(spark, str(tmp_path / "w"), {"t": ("k long, v long", ["k"])}, buckets=4)
    s.create()

    def write(n):
        for i in range(3):
            store.ResultStore(spark, s.folder, s.tables).upsert("t", spark.createDataFrame([(10 * n + i, n)], "k long, v long"))

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    assert sorted((r.k, r.v) for r in s.read("t").collect()) == sorted((10 * n + i, n) for n in range(3) for i in range(3))
    assert s._commits("t") == list(range(10))
    assert not s._commit("t", 9, {"buckets": 4, "at": {}})  # a number that is taken
