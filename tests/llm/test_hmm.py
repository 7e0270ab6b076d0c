import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from almanac.llm import hmm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def toks(t):
    return [*WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), None]


def out(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2


def small_model(states=3, n_classes=7, seed=1):
    r = np.random.default_rng(seed)
    return hmm.Model(r.dirichlet(np.ones(states)), r.dirichlet(np.ones(states), states), r.dirichlet(np.ones(n_classes), states))


def by_paths(cls, m):
    return sum(m.start[p[0]] * m.emit[p[0], cls[0]] * math.prod(m.step[a, b] * m.emit[b, c] for a, b, c in zip(p, p[1:], cls[1:])) for p in itertools.product(range(len(m.start)), repeat=len(cls)))


def test_forward_is_the_sum_over_paths():
    m, seqs = small_model(), [[1, 2, 0], [0], [3, 3, 4, 6, 0], [5, 0]]
    first = np.cumsum([0, *map(len, seqs)])
    got = hmm.forward(np.concatenate(seqs), first[:-1], np.diff(first), m)
    assert np.allclose(np.exp(got), [by_paths(s, m) for s in seqs])


def test_expected_counts_are_the_sums_over_paths(monkeypatch):
    monkeypatch.setattr(hmm, "TOKENS_AT_ONCE", 4)
    m, seqs = small_model(), [[1, 2, 0], [0], [3, 3, 4, 0], [5, 1, 0]]
    first = np.cumsum([0, *map(len, seqs)])
    c = hmm.Counts(3, 7)
    c.add(np.concatenate(seqs), first[:-1], np.diff(first), m)
    start, step, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 7))
    for s in seqs:
        z = by_paths(s, m)
        for p in itertools.product(range(3), repeat=len(s)):
            w = m.start[p[0]] * m.emit[p[0], s[0]] * math.prod(m.step[a, b] * m.emit[b, x] for a, b, x in zip(p, p[1:], s[1:])) / z
            start[p[0]] += w
            for a, b in zip(p, p[1:]):
                step[a, b] += w
            for a, x in zip(p, s):
                emit[a, x] += w
    assert np.allclose(c.start, start, atol=1e-5) and np.allclose(c.step, step, atol=1e-5) and np.allclose(c.emit, emit, atol=1e-5)
    assert abs(c.log - sum(math.log(by_paths(s, m)) for s in seqs)) < 1e-4


def test_rounds_raise_the_likelihood(spark, docs):
    rows = docs.where(~hmm.held_out(docs.doc_id)).select("text")
    seqs, logs = hmm.gathered(rows, 4, 64).where("part < 0").select("first", "cls"), []
    m = hmm.first_model(np.full(64, 1 / 64), 3)
    for _ in range(3):
        m, log, n = hmm.baum_welch(seqs, m)
        logs.append(log)
    assert logs[0] < logs[1] < logs[2] and n > 1000
    assert np.allclose(m.emit.sum(1), 1) and np.allclose(m.step.sum(1), 1) and abs(m.start.sum() - 1) < 1e-9


def test_sums_meet_in_a_tree(spark, docs, monkeypatch):
    rows = docs.where(~hmm.held_out(docs.doc_id)).select("text").repartition(7, "text")
    seqs = hmm.gathered(rows, 4, 64).where("part < 0").select("first", "cls")
    m = hmm.first_model(np.full(64, 1 / 64), 3)
    want = hmm.baum_welch(seqs, m)
    monkeypatch.setattr(hmm, "FAN_IN", 2)
    got = hmm.baum_welch(seqs, m)
    assert np.allclose(want[0].emit, got[0].emit) and np.allclose(want[1:], got[1:])


def test_rounds_go_on_until_the_gain_is_small(docs):
    log = []
    hmm.train_model(docs, states=3, n_classes=64, rounds=40, gain=0.01, log=log)
    gains = np.diff(log)
    assert 2 <= len(log) < 40 and (gains[:-1] >= 0.01).all() and 0 <= gains[-1] < 0.01


@pytest.fixture(scope="module")
def scored(docs):
    m = hmm.train_model(docs, n_classes=512, rounds=1)
    return m, hmm.score(docs, m).collect()


def test_scores_match_brute_force(odd, scored):
    m, got = scored
    m = m.model
    count = Counter(w for r in odd if not out(r[0]) for w in toks(r[1]))
    n, v = sum(count.values()), len(count)
    vocab = [w for w in {w for r in odd for w in toks(r[1])} if w is not None]
    cls = {None: 0} | {w: int(hmm.tokens(pa.array([w], pa.large_string()), 512, False)[1][0]) for w in vocab}
    n_g, v_g = Counter(), Counter()
    for w, c in count.items():
        n_g[cls[w]] += c
        v_g[cls[w]] += 1
    want = {}
    for d, t, *_ in odd:
        w = toks(t)
        a, log = None, 0.0
        for x in w:
            a = (m.start if a is None else a @ m.step) * m.emit[:, cls[x]]
            log += math.log10(a.sum())
            a = a / a.sum()
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)
        full = log + sum(math.log10((count[x] + 1) / (n_g[cls[x]] + v_g[cls[x]] + 1)) for x in w)
        want[d] = (out(d), len(w), sum(count[x] > 0 for x in w), n, base, full)
    assert len(got) == len(odd)
    for r in got:
        k = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == k[:4]
        assert math.isclose(r.base_score, k[4], rel_tol=1e-9) and math.isclose(r.score, k[5], rel_tol=1e-6)


def test_held_out_texts_are_likelier_than_under_the_base(scored):
    held = [r for r in scored[1] if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_words_of_a_class_sum_to_one_with_one_unknown():
    m = small_model()
    pairs = [[a, b] for a in range(7) for b in range(7)]
    got = hmm.forward(np.array(pairs).ravel(), np.arange(0, 98, 2), np.full(49, 2), m)
    assert abs(np.exp(got).sum() - 1) < 1e-9


def test_empty(no_docs, spark):
    m = hmm.train_model(no_docs, n_classes=64)
    assert hmm.score(no_docs, m).count() == 0
    rows = spark.createDataFrame([(None, None), (2, ""), (2, "")], "doc_id long, text string")
    got = hmm.score(rows, hmm.train_model(rows, n_classes=64)).collect()
    assert [(r.n_tokens, r.train_tokens) for r in got] == [(1, 3)] * 3
