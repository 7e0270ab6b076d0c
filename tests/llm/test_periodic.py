import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from almanac.llm import periodic, queries


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(w):
    """Every maximal run by the definition: for each start and end, extended words, smallest period."""
    out = set()
    n = len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_loop(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def plain_digest(doc_id, text):
    w = plain_loop(doc_id, words_of(text))
    runs = plain_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(kept))


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def periodic_texts(seed, n=120):
    rnd = random.Random(seed)
    texts = []
    for _ in range(n):
        t = []
        while rnd.random() < 0.75:
            unit = [rnd.choice("abc") for _ in range(rnd.randrange(1, 9))]
            t += [rnd.choice("abcdef") for _ in range(rnd.randrange(0, 9))] + unit * rnd.randrange(1, 14) + unit[: rnd.randrange(len(unit) + 1)]
        texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_scan_equals_the_definition(seed):
    texts = periodic_texts(seed)
    words, ids = periodic.word_ids([t.encode() for t in texts])
    assert [list(map(tuple, r.tolist())) for r in periodic.scan(ids)] == [plain_runs(w) for w in words]


def test_steps_miss_nothing():
    rnd = random.Random(5)
    for q in (3, 9, 40, 77):
        for extra in (-1, 0, 1, 3):
            unit = [rnd.randrange(10**6) for _ in range(q)]
            lead = [rnd.randrange(10**6) for _ in range(rnd.randrange(300))]
            run = (unit * 6)[: 4 * q + extra]
            w = np.array(lead + run + [-1] + [rnd.randrange(10**6) for _ in range(400)])
            got = [tuple(r) for r in periodic.scan([np.unique(w, return_inverse=True)[1]])[0].tolist()]
            assert got == ([(len(lead), 4 * q + extra, q)] if extra >= 0 else [])


def test_query_columns_against_the_definition(spark, odd, docs):
    got = periodic.digest(periodic.periodic_runs(periodic.looped(docs)))
    found = sorted(map(tuple, got.collect()), key=key)
    assert len(found) == len(odd)
    assert [r for r in found if r[0] not in (9003, 9004)] == sorted((plain_digest(r[0], r[1]) for r in odd if r[0] not in (9003, 9004)), key=key)
    plain = [r for r in found if r[0] in (9003, 9004) and zlib.crc32(str(r[0]).encode()) % 10]  # a very long text, whose lines at the end are a run of three words
    assert plain and all(r[1:5] == (1, 24000, 900, 3) for r in plain)


def test_long_texts_are_dealt_by_ranges_of_lags(spark):
    texts = [(k, t) for k, t in enumerate(periodic_texts(7, 60) + ["x " * 900, "", None])] + [(0, "x " * 900)]
    df = spark.createDataFrame([*texts, (None, "a b " * 30)], "doc_id long, text string").repartition(3)
    whole, dealt = (sorted(map(tuple, periodic.digest(periodic.periodic_runs(df, long_bytes=b)).collect()), key=key) for b in (1 << 30, 40))
    assert whole == dealt
    assert [r for r in whole if r[0] is None] == [(None, 1, 0, 60, 2, 30000, hashlib.sha256(b"0,60,2\n").hexdigest(), hashlib.sha256(b"a b").hexdigest())]


def test_registered_query(spark, sf):
    got = {r.doc_id: tuple(r) for r in queries.queries()["op11_periodic_runs"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    small = [r for r in rows if len(words_of(r.text)) <= 700]
    assert sum(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in small) > 5
    for r in small:
        assert got[r.doc_id] == plain_digest(r.doc_id, r.text)
    assert any(g[1] for g in got.values())


def test_empty(no_docs, spark):
    assert periodic.digest(periodic.periodic_runs(periodic.looped(no_docs))).count() == 0
    assert [tuple(r)[:2] for r in periodic.digest(periodic.periodic_runs(periodic.looped(spark.createDataFrame([(7, None)], "doc_id long, text string")))).collect()] == [(7, 0)]
