"""Radix selection against sorting."""

import math
import random

from almanac.functions.fixed import DEFAULTS
from almanac.operators import rank, selection


def test_medians_equal_sorting(spark):
    rnd = random.Random(8)
    odd = [0.0, -0.0, math.inf, -math.inf, 5e-324, -5e-324, 1.7e308, -1.7e308, math.nan, 1.0, math.nextafter(1.0, 2)]
    rows = [(g, h, x) for g, n in (("hot", 400), ("b", 31), (None, 6), ("one", 1)) for h in (None, 2) for x in [*(rnd.choice([rnd.gauss(0, 1), rnd.gauss(0, 1e-9), 3.25, *odd]) for _ in range(n)), None]]
    rows += [("nothing", 2, None)]
    df = spark.createDataFrame(rows, "g string, h int, x double").repartition(5)
    key = lambda x: (math.isnan(x), x)
    want = {}
    for g, h, x in rows:
        if x is not None:
            want.setdefault((g, h), []).append(x)
    want = {k: tuple(repr(sorted(v, key=key)[i] + 0.0) for i in ((len(v) - 1) // 2, len(v) // 2)) for k, v in want.items()}
    got = {(r.g, r.h): (repr(r.lower + 0.0), repr(r.upper + 0.0)) for r in selection.medians(df, ["g", "h"], "x", buffered=0).collect()}
    assert got == want
    assert selection.medians(df.limit(0), ["g"], "x").count() == 0 and selection.medians(df.limit(0), ["g"], "x", -1).count() == 0


def test_gates_are_the_same_by_either_plan(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(u, rnd.choice([None, 2020]), rnd.choice(["known", "unknown"]), rnd.choice([1, 5]), rnd.gauss(-11, 3)) for u in range(6) for _ in range(40)]
    df = spark.createDataFrame(rows, "uid long, year int, kind string, weight int, score double")
    small = sorted(map(tuple, rank.gates(df, ["uid", "year"], {**DEFAULTS, "leak_threshold": 0.5}).collect()), key=str)
    monkeypatch.setattr(rank, "BUFFERED", 0)
    monkeypatch.setattr(selection, "BUFFERED", 0)
    monkeypatch.setattr(rank, "medians", lambda *a: selection.medians(*a, buffered=0))
    assert sorted(map(tuple, rank.gates(df, ["uid", "year"], {**DEFAULTS, "leak_threshold": 0.5}).collect()), key=str) == small
