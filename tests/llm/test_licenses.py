import re

import pytest

from almanac.llm import licenses, queries


def words(t):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) if w]


def grams(w):
    return [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(rows, share=0.8):
    """Documents of which some run of 2 S shingles (at multiples of S) holds the share."""
    out = set()
    for d, t in rows:
        g = grams(words(t))
        for name, template in licenses.TEMPLATES:
            own = set(grams(words(template)))
            s = 1 << (len(own) - 1).bit_length()
            shares = [len(own & set(g[b : b + 2 * s])) / len(own) for b in range(0, max(len(g), 1), s)]
            if max(shares) >= share:
                first = min(b + min(i for i, x in enumerate(g[b : b + 2 * s]) if x in own) for b, h in zip(range(0, len(g), s), shares) if h >= share)
                out.add((d, name, round(max(shares), 9), first))
    return out


def got(df):
    return {(r.doc_id, r.license_id, round(r.containment, 9), r.first_word) for r in df.collect()}


def test_matches_brute_force(docs, odd):
    want = brute([(r[0], r[1]) for r in odd])
    assert got(licenses.scan(docs)) == want and want


def test_whole_and_changed_templates(spark):
    rows, k = [], 0
    for name, t in licenses.TEMPLATES:
        for lead in range(0, 40, 3):
            k += 1
            rows.append((k, " ".join(f"x{i}" for i in range(lead)) + "\n" + t.upper() + ". " + " ".join(f"y{i}" for i in range(lead * 3))))
        w = t.split()
        if len(w) > 35:
            k += 1
            rows.append((k, "some words " + " ".join([*w[:20], "changed", *w[21:]])))
        for cut in (0.5, 0.8, 0.85, 0.9, 0.95):  # around the share
            k += 1
            rows.append((k, "lead in " + " ".join(w[: int(len(w) * cut)]) + " and then something else"))
    want = brute(rows)
    found = got(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found <= want and len(want - found) <= 0.01 * len(want)
    assert licenses.miss_bound() < 0.002 and any(x[2] < 1 for x in want)


def test_edges(spark, no_docs):
    assert licenses.scan(no_docs).count() == 0
    rows = spark.createDataFrame([(None, "Released under the MIT License"), (1, None), (1, ""), (2, "Released under the MIT License. " * 500), (2, "Released under the MIT License. " * 500)], "doc_id long, text string")
    assert got(licenses.scan(rows)) == {(None, "mit", 1.0, 0), (2, "mit", 1.0, 0)}
    assert licenses.scan(rows, []).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(rows, [("short", "all rights reserved")])


def test_short_notices(spark, sf, docs, odd):
    notice = [("n", "all rights reserved")]
    own = ["all", "rights", "reserved"]
    at = {r[0]: [i for i in range(len(w)) if w[i : i + 3] == own] for r in odd for w in [words(r[1])]}
    want = {(d, "n", 1.0, p[0]) for d, p in at.items() if p}
    assert got(licenses.short_notices(docs, notice)) == want and want
    rows = spark.createDataFrame([(None, "ALL rights\nReserved."), (1, None), (1, ""), (2, "all rights are reserved"), (3, "x all rights reserved y all rights reserved"), (3, "x all rights reserved y all rights reserved"), (4, "x all rights")], "doc_id long, text string")
    assert {tuple(r) for r in licenses.short_notices(rows, notice).collect()} == {(None, "n", 1.0, 0, 1), (3, "n", 1.0, 1, 4)}
    assert licenses.short_notices(rows, notice).count() == 2 and licenses.short_notices(rows, []).count() == 0
    with pytest.raises(ValueError):
        licenses.short_notices(rows, [("long", "Released under the MIT License")])
    table = spark.read.parquet(f"{sf}/documents.parquet")
    planted = {r.doc_id for r in table.collect() if "All rights reserved." in (r.text or "")}
    assert {r.doc_id for r in queries.op5_license_scan(spark, sf).collect() if r.license_id == "all-rights-reserved"} == planted and planted


def test_gate_is_exact(spark):
    import random

    rnd = random.Random(4)
    entries = {rnd.randrange(-(2**63), 2**63): {k, (k * 7) % 5} for k in range(5) for _ in range(90)}
    others = [x ^ 1 << rnd.randrange(63) for x in entries] + [0, -1]
    for some in (entries, dict(list(entries.items())[:1])):
        of = licenses.gate(some)
        got = {r.h: r.m for r in spark.createDataFrame([(h,) for h in {*some, *others}], "h long").select("h", of(licenses.F.col("h")).alias("m")).collect()}
        assert got == {h: sum(1 << k for k in some[h]) if h in some else None for h in got}
