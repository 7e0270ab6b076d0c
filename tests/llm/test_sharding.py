import math
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from almanac.llm import sharding
from pyspark.sql import functions as F


def test_contract(docs, odd):
    got = sharding.assign(docs, 24).collect()
    assert len(got) == len(odd)
    by = {r[0]: r for r in odd}
    slots = defaultdict(list)
    for r in got:
        raw = (by[r.doc_id][1] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key") and 0 <= r.shard < 24
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def brute(key, nodes, weights=None, seed=7):
    """The descent in plain Python over XXH64 of the same bytes."""
    w = lambda s: (weights or {}).get(s, 1.0)

    def draw(level, node, weight):
        h = xxhash.xxh64_intdigest(key.encode(), 42)
        for x in (level, node, seed):
            h = xxhash.xxh64_intdigest(struct.pack("<i", x), h)
        return -math.log(((h >> 11) + 0.5) / 2**53) / weight

    racks, at = {}, 0
    for r, region in enumerate(nodes):
        racks[r] = {at + k: rack for k, rack in enumerate(region)}
        at += len(region)
    total = {r: {k: sum(map(w, rack)) for k, rack in inside.items()} for r, inside in racks.items()}
    region = min((draw(0, r, sum(x.values())), r) for r, x in total.items() if sum(x.values()))[1]
    rack = min((draw(1, k, x), k) for k, x in total[region].items() if x)[1]
    return min((draw(2, s, w(s)), s) for s in racks[region][rack] if w(s))[1]


def place(spark, n_rows, nodes, weights=None):
    rows = spark.range(n_rows).select("id", sharding.descend(F.col("id").cast("string"), nodes, weights).alias("shard"))
    return {r.id: r.shard for r in rows.collect()}


@pytest.mark.parametrize(("nodes", "weights"), [(sharding.tree(24), None), (sharding.tree(11), {3: 0.5, 7: 0.0, 10: 4.0}), (sharding.tree(5, 1, 1), None), ([[[0], [1, 2]], [[3]]], {0: 0.0, 3: 2.0})])
def test_matches_brute_force(spark, nodes, weights):
    assert place(spark, 500, nodes, weights) == {i: brute(str(i), nodes, weights) for i in range(500)}


@pytest.mark.parametrize("n", [1, 3, 4, 8, 9, 24, 25])
def test_growth_takes_rows_only_into_the_new_shard(spark, n):
    rows = spark.range(3000).withColumn("key", F.col("id").cast("string"))
    out = sharding.with_shards(rows, F.col("key"), n).collect()
    moved = [r for r in out if r.shard != r.grown_shard]
    assert all(r.grown_shard == n for r in moved) and 0.5 * 3000 / (n + 1) < len(moved) < 1.6 * 3000 / (n + 1)
    again = {r.id: r.shard for r in sharding.with_shards(rows, F.col("key"), n + 1, nodes=sharding.grow(sharding.tree(n))).collect()}
    assert all(again[r.id] == r.grown_shard for r in out)
    assert n % 8 or sharding.grow(sharding.tree(n)) == sharding.tree(n + 1)


def test_the_shape_of_the_tree_matters(spark):
    flat, regular, deep = (place(spark, 4000, sharding.tree(24, a, b)) for a, b in ((24, 1), (4, 2), (1, 24)))
    for x, y in ((flat, regular), (regular, deep)):
        assert sum(x[i] != y[i] for i in x) > 1000
    for x in (flat, regular, deep):
        assert all(100 < k < 250 for k in Counter(x.values()).values())


def test_a_weight_moves_rows_only_in_and_out_of_its_subtrees(spark):
    nodes = sharding.tree(16)
    even = place(spark, 6000, nodes)
    region, rack = lambda s: s // 8, lambda s: s // 4
    for weight in (3.0, 0.25, 0.0):
        new = place(spark, 6000, nodes, {5: weight})
        moved = [(even[i], new[i]) for i in even if even[i] != new[i]]
        assert moved
        into = [(b, a) if weight < 1 else (a, b) for a, b in moved]  # with less weight rows go the other way
        for a, b in into:
            assert region(b) == region(5)  # no row moves within another region, or into one
            if region(a) == region(5):
                assert rack(b) == rack(5)
            if rack(a) == rack(5):
                assert b == 5
    n = Counter(place(spark, 6000, nodes, {5: 3.0}).values())
    assert 2 < n[5] / (sum(v for k, v in n.items() if k != 5) / 15) < 4
    rows = spark.range(5).withColumn("key", F.col("id").cast("string"))
    for bad in ({0: -1.0}, {0: float("nan")}, dict.fromkeys(range(16), 0.0)):
        with pytest.raises(ValueError):
            sharding.with_shards(rows, F.col("key"), 16, bad)


def test_empty_and_null_ids(spark, no_docs):
    assert sharding.assign(no_docs, 24).count() == 0
    rows = spark.createDataFrame([(None, None, 7), (None, "a", 8), (1, "b", 9), (1, "b", 9)], "doc_id long, text string, shard int")
    assert sharding.assign(rows, 24).count() == 4
