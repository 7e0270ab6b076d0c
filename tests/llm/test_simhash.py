import random

import numpy as np
import pytest
import xxhash

from almanac.llm import simhash


def fp(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ")
    w = [x for x in w if x]
    s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(fps):
    """Least id by component of ids within two bits."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if b < a and (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("limit", [simhash.NODE_LIMIT, 2])
def test_documents_match_brute_force(docs, odd, limit):
    got = {(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs, node_limit=limit).collect()}
    fps = {r[0]: fp(r[1]) for r in odd}
    comp = brute(fps)
    assert got == {(d, fps[d], comp[d]) for d in fps}
    assert comp[9002] == comp[9001] == comp[9005]  # blank texts


@pytest.mark.parametrize("limit", [simhash.NODE_LIMIT, 3])
def test_links_connect_what_brute_force_connects(spark, limit):
    rnd = random.Random(4)
    base = [rnd.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1]
    vals = set(base)
    for b in base:
        x = b
        for _ in range(12):
            x ^= 1 << rnd.randrange(64)
            if rnd.random() < 0.5:
                x ^= 1 << rnd.randrange(64)
            vals.add(x)
    vals = sorted(vals)
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in vals], "fp long")
    roots = {r.u % 2**64: r.root % 2**64 for r in simhash.components(simhash.links(df, limit)).collect()}
    want = brute(dict(enumerate(vals)))
    groups, found = {}, {}
    for i, v in enumerate(vals):
        groups.setdefault(want[i], set()).add(v)
        found.setdefault(roots.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_long_chains(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "u long, v long")
    got = {r.u: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, n + 1)} | {1001: 1000}


def test_clean_keeps_one_of_each(spark, docs, odd, no_docs):
    out = simhash.clean(docs).collect()
    fps = {r[0]: fp(r[1]) for r in odd}
    assert sorted(r.doc_id for r in out) == sorted(set(brute(fps).values()))
    assert simhash.clean(docs).columns == docs.columns
    assert simhash.clean(no_docs).count() == 0 and simhash.near_duplicates(no_docs).count() == 0


def test_null_ids(spark):
    rows = spark.createDataFrame([(None, "a b c d"), (None, None), (5, "a b c d"), (7, "other words are here")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(rows).collect()} == {(None, 5), (None, None), (5, 5), (7, 7)}
    assert simhash.clean(rows).count() == 4
