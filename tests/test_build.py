import pytest
from almanac.operators import corpus
from almanac.operators.order import numbered, running_total
from almanac.plans import build
from pyspark.sql import functions as F


def test_config_layers():
    assert build.layered({"a": 1, "b": 2}, {"a": 3, "b": None}, None) == {"a": 3, "b": 2}
    assert build.load_config('{"x": [1]}') == {"x": [1]}
    assert build.date_window({"date_year": 2020}) == (2020, 2020) and build.date_window({"date_year_min": 1}) == (1, None)


def test_first_bank(spark):
    one = spark.createDataFrame([("p",)], "prompt string")
    assert build.first_bank(None, one.limit(0), one).first().prompt == "p"
    with pytest.raises(ValueError):
        build.first_bank(None)


def test_sources_obey_the_cutoff(spark):
    rows = spark.createDataFrame([(1, "text one here", "2017-01-01", 4), (2, "text two here", "2019-01-01", 4), (3, "text three here", None, 4), (4, "x", "2016", 4), (5, "text five here", "2016", 1)], "doc_id long, text string, day string, int_score int")
    spec = {"name": "s", "table": rows, "date_field": "day", "min_chars": 5, "min_int_score": 3}
    ids = lambda s, c=2018: sorted(r.id for r in build.source(spark, s, c).collect())
    assert ids(spec) == [1] and ids({**spec, "snapshot_year": 2018}) == [1, 3] and ids({**spec, "snapshot_year": 2018, "require_date": True}) == [1]
    assert ids({**spec, "min_int_score": None}) == [1, 5] and ids({**spec, "date_year": 2016, "min_int_score": None}) == [5]
    assert ids({**spec, "min_int_score": None, "start_offset": 1}) == [5]
    with pytest.raises(corpus.CutoffError):
        build.source(spark, {**spec, "snapshot_year": 2019}, 2018)
    with pytest.raises(corpus.CutoffError):
        build.build_corpus(spark, [], 2018)


def test_sequential_corpus_and_preprocessing(spark):
    rows = spark.createDataFrame([(1, "The council was elected in 2018 by a margin."), (2, "no")], "doc_id long, text string")
    specs = [{"name": "b", "table": rows, "snapshot_year": 2018}, {"name": "a", "table": rows, "snapshot_year": 2018, "preprocess": {"denoise": True, "claim_filter": True, "probe_rewrite": True}}]
    got = [(r.source, r.text) for r in build.build_corpus(spark, specs, 2018, sequential=True).orderBy("place").collect()]
    assert got == [("b", "The council was elected in 2018 by a margin."), ("b", "no"), ("a", "In 2018, The council was elected by a margin.")]
    turns = [(r.source, r.id, r.turn) for r in build.build_corpus(spark, specs, 2018, sequential=True, docs_per_turn=1).orderBy("place").collect()]
    assert turns == [("b", 1, 0), ("a", 1, 1), ("b", 2, 2)]
    assert {r.id for r in build.build_corpus(spark, specs[:1], 2018, docs_per_turn=1).collect()} == {1, 2}


def test_places_and_running_totals(spark):
    rows = spark.range(500).select(((F.col("id") * 37) % 500).alias("k"), F.when(F.col("id") % 5 < 4, "hot").alias("g"), (F.col("id") % 7).alias("v")).repartition(4)
    got = {r.k: r.pos for r in numbered(rows, ["k"], n_ranges=6).collect()}
    assert got == {k: k for k in range(500)}
    all_rows = sorted((r.g or "", r.k, r.v) for r in rows.collect())
    before, want = {}, {}
    for g, k, v in all_rows:
        want[k] = before.get(g, 0)
        before[g] = want[k] + v
    assert {r.k: r.before for r in running_total(rows, F.col("v"), ["g", "k"], ["g"], 6).collect()} == want
    assert numbered(rows.limit(0), ["k"]).count() == 0
