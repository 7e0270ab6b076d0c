import hashlib
import math
import random

import numpy as np
import pytest
from almanac.llm import codes, queries

SCHEMA = "vec_id long, embedding array<float>, label int, note string"


def plain(rows, rounds=4):
    """The contract in plain Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][1]) // 4
    part = lambda v, p: v[p * w : p * w + w]
    books = [[part(v, p) for _, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:256]] for p in range(4)]

    def near(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            got = {}
            for _, v, _ in kept:
                got.setdefault(near(books[p], part(v, p))[1], []).append(part(v, p))
            books[p] = [[sum(c) // len(got[k]) for c in zip(*got[k], strict=True)] if k in got else e for k, e in enumerate(books[p])]
    out, by = [], {}
    for i, v, lab in kept:
        f = [near(books[p], part(v, p)) for p in range(4)]
        out.append([i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), lab])
        by[lab] = by.get(lab, 0) + out[-1][2]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by[lab], sha) for i, c, e, lab in out), key=str)


def vectors(seed, n=420, width=12):
    rnd = random.Random(seed)
    rows = [(i * 3 % 1009, [rnd.choice([rnd.gauss(0, 1), rnd.randrange(-3, 3) / 2]) for _ in range(width)], rnd.choice([None, 1, 2, 2, 2])) for i in range(n)]
    rows = [(i, np.array(v, np.float32).tolist(), lab) for i, v, lab in rows]
    rows += [rows[7], rows[8], (None, rows[3][1], None), (5000, None, 1), (5001, [None] + rows[0][1][1:], 1), (5002, [float("nan")] + rows[0][1][1:], 1), (5003, [float("-inf")] + rows[0][1][1:], 1), (5004, [], 2)]
    return rows


@pytest.mark.parametrize("labels", [codes.BROADCAST_LABELS, 1])
def test_against_plain_integers(spark, monkeypatch, labels):
    rows = vectors(labels % 7)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).selectExpr("*", "1 AS v", "'clash' AS code", "2 AS error", "3 AS of").repartition(3)
    found, books = codes.compress(df, broadcast_labels=labels)
    got = sorted(((*r, codes.fingerprint(books)) for r in found.collect()), key=str)
    assert got == plain(rows)


def test_ties_go_to_the_smaller_index_and_bounds_lose_nothing():
    rnd = np.random.default_rng(3)
    for width, spread in ((1, 40), (2, 9), (4, 3), (16, 900), (2, 1 << 29), (16, 1 << 27)):
        book = rnd.integers(-spread, spread, (256, width))
        x = np.concatenate([rnd.integers(-spread - 3, spread + 3, (700, width)), book])
        n = codes.Nearest(book)
        at, d = n.find(x)
        every = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (at == every.argmin(1)).all() and (d == every.min(1)).all()
        if width <= 2:
            assert n.compared < 0.6 * len(x) * len(book)


def test_few_equal_and_no_vectors(spark):
    same = [(k, [0.5, 0.25, -0.125, 1.0], k % 2) for k in range(9)]
    assert sorted((tuple(r) for r in codes.digest(spark.createDataFrame([(*r, "x") for r in same], SCHEMA)).collect()), key=str) == plain(same)
    assert codes.digest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert codes.digest(spark.createDataFrame([(1, None, 1, ""), (2, [None, 1.0, 1.0, 1.0], 1, "")], SCHEMA)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_what_cant_be_coded_is_an_error(spark):
    df = lambda rows: spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    with pytest.raises(ValueError, match="multiple"):
        codes.digest(df([(1, [1.0, 2.0, 3.0])]))
    with pytest.raises(Exception, match="2\\^62"):
        codes.digest(df([(1, [1e9] * 4), (2, [-1e9] * 4)])).collect()


def test_registered_query(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in queries.queries()["op12_vector_codes"](spark, sf).collect()), key=str) == plain(rows, 4)
