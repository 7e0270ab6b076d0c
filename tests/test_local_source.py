"""A local source's epochs: permutations without a table, and states in the middle of one."""

import json

import pytest
from almanac.operators import corpus
from almanac.operators.order import permuted
from pyspark.sql import functions as F


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 1000])
def test_permutations(spark, n):
    rows = spark.range(n).select(*(permuted(F.col("id"), n, F.lit(42), F.lit(e)).alias(f"e{e}") for e in range(3))).collect()
    for e in range(3):
        assert sorted(r[e] for r in rows) == list(range(n))
    if n >= 17:
        assert len({tuple(r[e] for r in rows) for e in range(3)}) == 3


def test_a_state_in_epoch_three_gives_the_rest_of_one_long_scan(spark):
    docs = spark.createDataFrame([(f"f{k % 3}", k, f"text {k}") for k in range(23)], "path string, pos long, text string").repartition(3)
    order = ["path", "pos"]
    begin = corpus.local_state(docs, "/here", order)
    told = lambda df: [(r.place, r.epoch, r.text) for r in df.orderBy("place").collect()]
    whole, end = corpus.local_scan(docs, begin, 23 * 4 + 5, order)
    all_ = told(whole)
    assert [p for p, _, _ in all_] == list(range(97)) and all(e == p // 23 for p, e, _ in all_) and (end["cycle"], end["offset"]) == (4, 5)
    for e in range(4):
        assert len({t for _, x, t in all_ if x == e}) == 23
    assert [t for _, e, t in all_ if e == 0] != [t for _, e, t in all_ if e == 1]
    part, state = corpus.local_scan(docs, begin, 3 * 23 + 7, order)
    rest, last = corpus.local_scan(docs, corpus.checked_local_state(json.loads(json.dumps(state)), docs, "/here", order), 97 - 76, order)
    assert told(part) + told(rest) == all_ and last == end


def test_no_cycle_no_shuffle_and_foreign_states(spark):
    docs = spark.createDataFrame([(k, f"t{k}") for k in range(9)], "id long, text string")
    s = corpus.local_state(docs, "/p", ["id"], shuffle=False, cycle=False, start=4)
    rows, end = corpus.local_scan(docs, s, 100, ["id"])
    assert [r.id for r in rows.orderBy("place").collect()] == [4, 5, 6, 7, 8] and end["offset"] == 9
    assert corpus.local_scan(docs, end, 5, ["id"])[0].count() == 0
    for wrong in (lambda: corpus.checked_local_state(s, docs, "/q", ["id"]), lambda: corpus.checked_local_state(s, docs.where("id > 0"), "/p", ["id"]), lambda: corpus.local_scan(docs.limit(3), s, 1, ["id"]), lambda: corpus.local_scan(docs, {**s, "version": "local_v3"}, 1, ["id"]), lambda: corpus.local_state(docs.limit(0), "/p", ["id"])):
        with pytest.raises(ValueError):
            wrong()
