"""Drawn and sequential mixes and skill sampling against plain loops."""

import hashlib
import json
import random

import numpy as np
import pytest
from almanac.functions.fixed import SKILLS
from almanac.operators import corpus, mixing, sampling
from pyspark.sql import functions as F


def u(*key):
    return int(hashlib.md5("|".join(map(str, key)).encode()).hexdigest()[:8], 16) / 2**32


def plain_mix(sizes, weights, d, seed, sequential):
    n = len(sizes)
    given, dead, out, t, nxt = [0] * n, [False] * n, [], 0, 0
    while True:
        living = [i for i in range(n) if not dead[i] and (sequential or weights[i] > 0)]
        if not living:
            return out
        if sequential:
            while dead[nxt % n]:
                nxt += 1
            i, nxt = nxt % n, nxt + 1
        else:
            total, low, i = sum(weights[j] for j in living), 0.0, living[-1]
            for j in living[:-1]:
                low += weights[j] / total
                if u(seed, t) < low:
                    i = j
                    break
        for _ in range(d):
            if given[i] >= sizes[i]:
                dead[i] = True
                break
            out.append((f"s{i}", given[i], t))
            given[i] += 1
        t += 1


@pytest.mark.parametrize("sequential, sizes, weights, d", [(False, [40, 8, 0, 13], [1, 3, 2, 0.5], 4), (True, [9, 3, 5], [1, 1, 1], 2), (True, [4, 0, 4], [1, 1, 1], 2), (False, [30, 30], [1, 1], 7)])
def test_mix_equals_the_loop_whole_and_cut(spark, sequential, sizes, weights, d):
    names = [f"s{i}" for i in range(len(sizes))]
    rows = spark.createDataFrame([(names[i], k) for i, n in enumerate(sizes) for k in range(n)] + [("other", 1)], "source string, id long").repartition(3)
    want = plain_mix(sizes, weights, d, 42, sequential)
    state = mixing.mix_state(names, d, 42, sequential)
    w = dict(zip(names, weights, strict=True))
    run = lambda s, n: mixing.mixed(rows, w, s, n)
    told = lambda df: [(r.source, r.id, r.turn) for r in sorted(df.collect(), key=lambda r: r.place)]
    whole, end = run(state, None)
    assert told(whole) == want and sorted(r.place for r in whole.collect()) == list(range(len(want)))
    assert all(end.dead[i] for i in range(len(sizes)) if sequential or weights[i] > 0)
    got = []
    for n in (d + 1, 1, len(want)):
        part, state = run(mixing.restored(json.loads(json.dumps(state.to_dict())), names), n)
        got += told(part)
    assert got == want and run(state, None)[0].count() == 0


def test_long_draws_are_searched_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    counts, t, want = {0: 0, 1: 0}, 100, None
    while want is None:
        i = 0 if u(5, t) < 0.25 else 1
        counts[i] += 1
        want = (t, i) if counts == {0: 30, 1: counts[1]} or counts[1] == 200 else None
        t += 1
    assert mixing.nth_turn(spark, 100, [0, 1], [1.0, 3.0], 5, {0: 30, 1: 200}) == want


def test_states_are_checked_and_migrated():
    s = mixing.mix_state(["a", "b"], 3).to_dict()
    assert mixing.restored(s, ["a", "b"]).to_dict() == s
    old = {k: v for k, v in s.items() if k not in ("names", "dead")} | {"version": "mix_v1", "turn": 4}
    assert mixing.restored(old, ["a", "b"]) == mixing.MixState(**{**s, "turn": 4})
    for bad, names in (({**s, "version": "mix_v9"}, ["a", "b"]), (s, ["b", "a"]), ({**old, "given": [1]}, ["a", "b"])):
        with pytest.raises(ValueError):
            mixing.restored(bad, names)
    for wrong in (lambda: mixing.mix_state([]), lambda: mixing.mix_state(["a", "a"]), lambda: mixing.mix_state(["a"], 0)):
        with pytest.raises(ValueError):
            wrong()


NAMES = [n for n, _ in SKILLS]


def plain_sample(cats, fraction, skips, any_skill):
    out, s, draw, n = [], 0, 0, len(cats)
    while s < n:
        if u("hunt", 42, s) >= fraction:
            out.append((s, draw, s, None))
            s += 1
        else:
            target = min(int(u("skill", 42, s) * len(NAMES)), len(NAMES) - 1)
            if any(c == target for c in cats[s : s + skips]):
                k = next(p for p in range(s, s + skips) if cats[p] == target)
                out.append((k, draw, s, NAMES[target]))
                s = k + 1
            elif s + skips > n:
                return out
            else:
                first = next((p for p in range(s, s + skips) if cats[p] >= 0), None) if any_skill else None
                out.append((first if first is not None else s + skips - 1, draw, s, NAMES[target]))
                s += skips
        draw += 1
    return out


@pytest.mark.parametrize("n, fraction, skips, any_skill, block", [(500, 0.4, 9, True, 40), (300, 0.9, 20, False, 1), (150, 1.0, 64, True, 1 << 20), (40, 0.0, 3, True, 7), (1, 1.0, 1, True, 1)])
def test_sampling_equals_the_loop(spark, n, fraction, skips, any_skill, block):
    rnd = random.Random(n)
    cats = [rnd.choice([-1, -1, *range(len(NAMES))]) for _ in range(n)]
    rows = spark.createDataFrame([(k * 3, "long enough", NAMES[c] if c >= 0 else None) for k, c in enumerate(cats)] , "id long, text string, skill string").repartition(3)
    run = lambda **k: sorted((r.id // 3, r.draw, r.start, r.hunted) for r in sampling.sampled(rows, F.col("skill"), "id", fraction, None, skips, any_skill, 5, block=block, **k).collect())
    want = sorted(plain_sample(cats, fraction, skips, any_skill))
    assert run() == want
    if block == 40:
        assert run(driver_blocks=2, run=3) == want  # maps composed by runs, and runs of runs


def test_short_texts_have_no_skill_and_none_gives_none(spark):
    rows = spark.createDataFrame([(k, "x" * (k % 4)) for k in range(60)], "id long, text string")
    got = sampling.sampled(rows, F.lit(NAMES[0]), "id", 1.0, {NAMES[0]: 1.0}, 3, True, 3).collect()
    assert got and all(len(r.text) == 3 for r in got if r.start + 2 < 60 and any((r.start + i) % 4 == 3 for i in range(3)))
    assert sampling.sampled(rows.limit(0), F.lit(NAMES[0]), "id").count() == 0
    with pytest.raises(ValueError):
        sampling.sampled(rows, F.lit(None), "id", 1.5)


def test_exits_by_doubling():
    rnd = np.random.default_rng(1)
    after = np.arange(100) + rnd.integers(1, 9, 100)
    for entry, got in enumerate(sampling.exits(after, 90, 8)):
        at = entry
        while at < 90:
            at = int(after[at])
        assert at == got


def test_packing_goes_on_from_its_buffer(spark):
    rnd = random.Random(6)
    docs = [(k, [rnd.randrange(1, 99) for _ in range(rnd.choice([0, 1, 3, 8, 40]))] if k % 7 else None) for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, ids array<int>").repartition(3)
    flat = [x for _, ids in docs if ids for x in [*ids, 0]]
    want = {k: flat[16 * k : 16 * k + 16] for k in range(len(flat) // 16)}
    got, state = {}, None
    for lo, hi in ((0, 20), (20, 21), (21, 21), (21, 50), (50, 60)):
        blocks, state = corpus.pack_on(df.where((F.col("doc_id") >= lo) & (F.col("doc_id") < hi)), 16, json.loads(json.dumps(state)) if state else None)
        got |= {r.block_id: r.input_ids for r in blocks.collect()}
    assert got == want and state["buffer"] == flat[16 * len(want) :] and state["blocks"] == len(want)
    assert {r.block_id: r.input_ids for r in corpus.pack_blocks(df, 16).collect()} == want
    with pytest.raises(ValueError):
        corpus.pack_on(df, 8, state)
