import pytest
from almanac.functions import names
from almanac.functions.fixed import DEFAULTS, PUBLISHED
from almanac.operators import rank
from pyspark.sql import functions as F


def test_normalisation_truth_table(spark):
    rows = spark.createDataFrame([(float(x),) for x in (-100, -8, -6, -4.5, -3, 0, 1)], "s double")
    assert [r[0] for r in rows.select(rank.normalised(F.col("s"))).collect()] == [1, 1, 1, 0.5, 0, 0, 0]
    swapped = {**DEFAULTS, "min_eval_score": -6.0, "leak_epsilon": -3.0}
    assert [r[0] for r in rows.where("s IN (-6, -4.5, -3)").select(rank.normalised(F.col("s"), swapped)).collect()] == [0, 0.5, 1]


def test_qualifiers_and_winner(spark):
    scores = spark.createDataFrame([(1, -6.0), (2, -3.5), (3, -2.5), (4, 0.0), (5, 0.0), (6, 0.0)], "uid long, score double")
    q = rank.qualify(scores)
    assert [(r.uid, r.rank) for r in q.orderBy("rank").collect()] == [(1, 1), (2, 2)]
    rates = spark.createDataFrame([(1, 0.6), (2, 0.4)], "uid long, win_rate double")
    paid = rank.rewards(rank.final_scores(q, rates), {**DEFAULTS, "emission_pct": 0.3}).collect()
    w = {r.uid: r.weight for r in paid}
    assert abs(sum(w.values()) - 1) < 1e-9 and abs(w[0] - 0.7) < 1e-9 and w[1] > w[2]


def test_threshold_is_strict_and_single_qualifier_wins(spark):
    scores = spark.createDataFrame([(1, -3.0), (2, -3.1)], "uid long, score double")
    q = rank.qualify(scores)
    f = rank.final_scores(q, spark.createDataFrame([], "uid long, win_rate double")).collect()
    assert [(r.uid, r.final) for r in f] == [(2, 1.0)]
    none = rank.qualify(scores.where("uid = 1"))
    assert rank.rewards(rank.final_scores(none, spark.createDataFrame([], "uid long, win_rate double"))).count() == 0


def test_reward_curve(spark):
    f = spark.createDataFrame([(i, 1.0 - i / 100, i) for i in range(1, 13)], "uid long, final double, rank int")
    got = [round(r.weight, 4) for r in rank.rewards(f).orderBy("place").collect()]
    assert got == [0.5203, 0.2338, 0.1169, 0.0606, 0.0321, 0.0173, 0.0094, 0.0052, 0.0029, 0.0016]


def test_win_rates_credit_losers(spark):
    v = spark.createDataFrame([(1, 2, "a" if i < 60 else "b", False) for i in range(100)] + [(1, 3, "tie", True)] * 10, "uid_a long, uid_b long, raw string, swap boolean")
    got = {r.uid: (r.wins, r.prompts) for r in rank.win_rates(rank.tally(v, ["uid_a", "uid_b"])).collect()}
    assert got == {1: (60, 110), 2: (40, 100), 3: (0, 10)}


def test_swapped_verdicts(spark):
    v = spark.createDataFrame([(r, s) for r in ("a", "b", "tie") for s in (True, False)], "raw string, swap boolean")
    got = [r[0] for r in v.select(rank.unswapped(F.col("raw"), F.col("swap"))).collect()]
    assert got == ["b", "a", "a", "b", "tie", "tie"]


def test_gates_with_a_missing_side(spark):
    rows = spark.createDataFrame([(1, 2020, "known", 1, -1.0), (2, 2020, "unknown", 1, -30.0), (3, 2020, "known", 5, -1.0), (3, 2020, "known", 1, -20.0), (3, 2020, "unknown", 1, -15.0)], "uid long, year int, kind string, weight int, score double")
    got = {r.uid: (r.known_ok, r.unknown_ok, r.score) for r in rank.year_scores(rows).collect()}
    assert got == {1: (True, True, -19.0), 2: (False, True, 0.0), 3: (True, True, -14.0)}
    mean = {r.uid: r.score for r in rank.leak_scores(rank.year_scores(rows), [2020, 2021]).collect()}
    assert mean == {1: -9.5, 2: 0.0, 3: -7.0}


def test_upper_and_lower_median(spark):
    rows = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 4.0)], "x double")
    assert rows.agg(rank.upper_median("x"), rank.lower_median("x")).first()[:] == (3.0, 2.0)


def test_repositories(spark):
    rows = spark.createDataFrame([("user/model@" + "a" * 40,), ("user/model@main",), ("user/model",), ("user/model@abc123",), ("a@b/c@" + "f" * 40,)], "r string")
    got = rows.select(names.is_commit(F.col("r")), names.repo_parts(F.col("r"))["name"], names.repo_parts(F.col("r"))["revision"]).collect()
    assert [x[0] for x in got] == [True, False, False, False, False]
    assert got[4][1:] == ("a@b/c", "f" * 40) and got[2][1:] == ("user/model", None)


def test_known_and_unknown(spark):
    facts = spark.createDataFrame([("p", "f", y) for y in (1999, 2012, 2013)], "prompt string, phrase string, year int")
    assert [(r.year, r.weight) for r in rank.build_benchmark(facts, 2012, True).orderBy("year").collect()] == [(1999, 1), (2012, 5)]
    assert [(r.year, r.weight) for r in rank.build_benchmark(facts, 2012, False).collect()] == [(2013, 1)]


def test_cache(spark):
    s = "uid long, year int, evaluated_at long, score double"
    old, new = spark.createDataFrame([(1, 2020, 1, 0.1), (2, 2020, 2, 0.2), (3, 2020, 9, 0.3)], s), spark.createDataFrame([(1, 2020, 5, 0.9)], s)
    up = rank.upsert(old, new, ["uid", "year"], "evaluated_at")
    assert {(r.uid, r.score) for r in up.collect()} == {(1, 0.9), (2, 0.2), (3, 0.3)}
    assert {r.uid for r in rank.delete_after_last(up, 1).collect()} == {1, 2} and rank.delete_after_last(up, 77).count() == 3
    assert rank.insert_ignore(old, new, ["uid", "year"]).count() == 3


def test_published_preset_is_win_rate_only(spark):
    q = spark.createDataFrame([(1, -6.0, 1.0, 1), (2, -4.0, 0.3, 2)], "uid long, score double, normalised double, rank int")
    rates = spark.createDataFrame([(1, 0.25), (2, 0.75)], "uid long, win_rate double")
    assert {r.uid: r.final for r in rank.final_scores(q, rates, PUBLISHED).collect()} == pytest.approx({1: 0.25, 2: 0.75})
