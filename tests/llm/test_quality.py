import re
from collections import Counter, defaultdict

import pytest
import xxhash

from almanac.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    covered = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    seen, dup = set(), 0
    for x in text.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    r = len(covered)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, r, len(w) < 20 or 100 * r > 30 * len(w)


def test_base_figures_match_brute_force(docs, odd):
    got = sorted(tuple(r)[:7] for r in quality.judge(docs).collect())
    assert got == sorted((d, *brute(t)) for d, t, *_ in odd)


def test_null_ids_and_columns(spark, docs):
    rows = spark.createDataFrame([(None, "x " * 30, None), (None, None, None), (1, "y z " * 30, "h")], "doc_id long, text string, source string")
    assert quality.judge(rows).count() == 3
    assert quality.clean(rows).count() <= 3


def test_empty(no_docs):
    assert quality.judge(no_docs).count() == 0
    assert quality.clean(no_docs).columns == no_docs.columns


def _corpus(spark):
    body = lambda i: " ".join(f"t{i}x{j}" for j in range(40))
    rows = [(i, f"Cookie  NOTICE of this site\n{body(i)}", "h") for i in range(60)]
    rows += [(i, f"cookie notice of this site\n{body(i)}", "g") for i in range(100, 105)]
    rows += [(200, "cookie notice of this site\n" * 3 + "only ten words of its own are left in here", "h")]
    rows += [(i, "copy of one text " + body(999) + "\nand " + body(998), "h") for i in range(300, 340)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", quality.F.length("text").cast("long"))


def norm(line):
    return " ".join(x.lower() for x in WORD.findall(line))


def brute_lines(rows, line_docs=quality.LINE_DOCS):
    """(host, line) held by more than this many distinct texts: rows are (doc_id, text, host)."""
    held = defaultdict(set)
    for _, text, host in rows:
        for x in (text or "").split("\n"):
            if norm(x):
                held[host or "", norm(x)].add(text)
    return {k for k, v in held.items() if len(v) > line_docs}


def brute_judge(rows, line_docs=quality.LINE_DOCS):
    """(figures, removed words, kept, text without frequent lines) of each row."""
    often, out = brute_lines(rows, line_docs), []
    for d, text, host in rows:
        lines = (text or "").split("\n")
        gone = [i for i, x in enumerate(lines) if (host or "", norm(x)) in often]
        removed = sum(len(WORD.findall(lines[i])) for i in gone)
        figures = brute(text)
        kept = not figures[-1] and figures[0] - removed >= quality.LEFT_SHARE * figures[0]
        out.append((d, *figures, removed, kept, "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text))
    return out


@pytest.mark.parametrize("line_docs", [0, 1, 3, 20])
def test_verdicts_match_brute_force(docs, odd, line_docs):
    rows = [(r[0], r[1], r[3]) for r in odd]
    want = brute_judge(rows, line_docs)
    assert sorted(tuple(r) for r in quality.judge(docs, line_docs=line_docs).collect()) == sorted(x[:9] for x in want)
    got = Counter((r.doc_id, r.text) for r in quality.clean(docs, line_docs=line_docs).select("doc_id", "text").collect())
    assert got == Counter((x[0], x[9]) for x in want if x[8])
    assert line_docs > 1 or any(x[7] and not x[8] for x in want)


def found(docs, **limits):
    """Frequent lines by their place in the smallest document that holds them."""
    rows = quality.prepared(docs)
    often = quality.frequent_lines(rows, **limits)
    each = rows.select("doc_id", "host", quality.F.inline("lines")).join(often, ["host", "h"])
    return Counter((r.host, r.first) for r in each.groupBy("host", "h").agg(quality.F.min("doc_id").alias("first")).collect())


def test_frequent_lines_by_host(spark):
    rows = _corpus(spark)
    assert found(rows) == {("h", 0): 1}  # not in host g, and copies of one document count once
    got = {r.doc_id: r for r in quality.judge(rows).collect()}
    assert got[0].n_removed_words == 5 and got[1].n_removed_words == 5 and got[100].n_removed_words == 0
    assert all(got[i].kept for i in [*range(60), *range(100, 105), *range(300, 340)])
    assert not got[200].kept and got[200].n_removed_words == 15  # depleted


@pytest.mark.parametrize("wording", range(4))
def test_all_lines_of_a_shared_header_are_found(spark, wording):
    header = "\n".join(f"header {wording} line {k} of this site" for k in range(10))
    docs = spark.createDataFrame([(i, header + "\n" + " ".join(f"own{i}x{j}" for j in range(40)), "h") for i in range(200)], "doc_id long, text string, source string")
    assert found(docs) == {("h", 0): 10}
    got = quality.judge(docs).collect()
    assert all(r.n_removed_words == 70 and r.kept == (40 >= 0.3 * r.n_words) for r in got)


def test_clean_cuts_lines_and_drops_rejects(spark):
    rows = _corpus(spark)
    out = {r.doc_id: r for r in quality.clean(rows).collect()}
    kept = {r.doc_id for r in quality.judge(rows).where("kept").collect()}
    before = {r.doc_id: r.text for r in rows.collect()}
    assert set(out) == kept
    assert out[0].text == before[0].split("\n", 1)[1] and out[1].text == before[1].split("\n", 1)[1] and out[100].text == before[100]
    assert all(r.n_chars == len(r.text) for r in out.values())


def test_repeated_rows_do_not_change_verdicts(spark):
    rows = _corpus(spark)
    once = {tuple(r) for r in quality.judge(rows).collect()}
    twice = quality.judge(rows.unionAll(rows)).collect()
    assert {tuple(r) for r in twice} == once and len(twice) == 2 * rows.count()


def test_lines_of_least_hash_are_counted(spark):
    lines = [f"shared line {k} of the host" for k in range(12)]
    least = lines[min(range(12), key=lambda k: xxhash.xxh64_intdigest(lines[k].encode(), seed=42) + 2**63 & 2**64 - 1)]
    rows = [(i, f"{least}\n" + " ".join(f"own{i}x{j}" for j in range(25)), "h") for i in range(30)]
    rows += [(100 + i, "\n".join([*lines, f"end of {i}"]), "g") for i in range(30)]
    rows += [(200 + i, f"{least}\n" + " ".join(f"one{j}" for j in range(25)), "c") for i in range(30)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string, source string")) == {("h", 0): 1, ("g", 100): 12}


def test_verdict_does_not_hinge_on_the_host(spark):
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(25))
    rows = [(n * 10_000 + i, f"subscribe to our news\n{own(i)}", h) for n, h in enumerate("abc") for i in range(60)]
    rows += [(11_000 + i, own(999), "b") for i in range(3000)]
    rows += [(21_000 + i, f"text {i}", "c") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert set(found(docs)) == {("a", 0), ("b", 10_000), ("c", 20_000)}
    assert {h for h, _ in found(docs, line_share=0.03)} == {"a", "b"}  # copies are in neither side of a share
