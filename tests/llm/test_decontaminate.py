import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from almanac.llm import decontaminate, fmindex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, bench):
    wins = {}
    for i, t in bench:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[k : k + 13]), set()).add("" if i is None else str(i))
    sizes = {len(x) for x in wins}
    out = []
    for d, t in docs:
        w, hit, items = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if x := wins.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    items |= x
        out.append((d, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def bench_rows(spark, sf):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]


@pytest.mark.parametrize("block_windows, most_blocks", [(decontaminate.BLOCK_WINDOWS, decontaminate.MOST_BLOCKS), (300, decontaminate.MOST_BLOCKS), (300, 2)])
def test_matches_brute_force(spark, sf, docs, odd, block_windows, most_blocks):
    b = bench_rows(spark, sf)
    b += [(900, "the of"), (901, "Of, THE!"), (902, None), (903, " .. "), (None, b[0][1]), (904, b[1][1]), (905, "a b c d e f g h i j k l m n"), b[2]]
    bench = spark.createDataFrame(b, "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.digest(docs, bench, block_windows=block_windows, most_blocks=most_blocks).collect()), key=str)
    want = brute([(r[0], r[1]) for r in odd], b)
    assert got == want
    n = len(list(decontaminate.blocks_of(bench, "item_id", "text", 13, block_windows)))
    assert n == 1 if block_windows == decontaminate.BLOCK_WINDOWS else n > 3
    assert sum(r[2] > 13 for r in want) > 3 and any(r[5] for r in want) and not all(r[5] for r in want)


def test_clean(spark, docs, no_docs):
    p = " ".join(f"q{i}" for i in range(13))
    bench = spark.createDataFrame([(1, p)], "item_id long, text string")
    long = " ".join(f"w{i}" for i in range(300))
    rows = spark.createDataFrame([(1, f"{long} ({p.upper()}). End", 0, "a"), (2, f"x {p}", 0, "b"), (3, "clean text", 10, None), (4, None, None, None)], "doc_id long, text string, n_chars long, extra string")
    out = {r.doc_id: r for r in decontaminate.clean(rows, bench).collect()}
    assert set(out) == {1, 3, 4} and out[1].text == f"{long} (). End" and out[1].n_chars == len(out[1].text) and out[3].text == "clean text"
    many = spark.createDataFrame([(k, " ".join(f"z{k}q{i}" for i in range(13))) for k in range(40)] + [(1, p)], "item_id long, text string")
    assert {r.doc_id: r for r in decontaminate.clean(rows, many, block_windows=40, most_blocks=3).collect()} == out
    assert decontaminate.clean(no_docs, bench).count() == 0 and decontaminate.digest(no_docs, bench).count() == 0
    none = decontaminate.digest(docs, bench.limit(0)).collect()
    assert none and not any(r.n_hit for r in none)


def test_index_against_plain_search():
    rnd = np.random.default_rng(5)
    for sigma, n in ((2, 400), (5, 700), (60, 500), (3, 1)):
        seq = rnd.integers(1, sigma + 1, n)
        if n > 300:
            seq[200:300] = seq[0:100]  # long repeats
        order = fmindex.suffix_order(np.append(seq, 0))
        text = [*seq.tolist(), 0]
        assert order.tolist() == sorted(range(n + 1), key=lambda i: text[i:])
        index = fmindex.FMIndex(seq, sample=7)
        pats = [seq[i : i + k] for i in range(0, n, 17) for k in (1, 3, 6) if i + k <= n] + [np.array([sigma + 9]), np.array([1, sigma, 1, sigma, 1])]
        m = np.zeros((len(pats), 6), np.int64)
        for r, p in enumerate(pats):
            m[r, 6 - len(p) :] = p
        lo, hi = index.search(m, np.array([len(p) for p in pats]))
        for p, a, b in zip(pats, lo, hi, strict=True):
            want = [i for i in range(n - len(p) + 1) if (seq[i : i + len(p)] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_a_shard_gives_the_same_with_all_words_and_with_the_searched_ones():
    texts = pa.array(["a b c d e", "x y z", "", "e d c b a b c"], pa.large_string())
    ph = decontaminate.phrases(["i", "j", "k"], pa.array(["b c", "y", "q r"], pa.large_string()), 2)
    got = []
    for known in (None, ph.words):
        shard = decontaminate.Shard(texts, known)
        met = shard.search(ph)
        got.append((shard.hit.tolist(), [x.tolist() for x in met]))
    assert got[0] == got[1] and got[0][1] == [[0, 1, 3], [0, 1, 0]] and sum(got[0][0]) == 5
