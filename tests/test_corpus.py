import random
import re
from collections import Counter

import pytest
from almanac.functions import vectors
from almanac.operators import bpe, corpus, duplicates
from almanac.sources import sinks, text_files
from pyspark.sql import functions as F


def test_quality_short_circuit(spark):
    rows = spark.createDataFrame([(None, 0.0), (1, 9.0), (3, None), (3, 1.0), (3, 2.0)], "i int, s double")
    got = [r[0] for r in rows.select(corpus.passes_quality(F.col("i"), F.col("s"), 3, 2.0)).collect()]
    assert got == [True, False, True, False, True]
    assert [r[0] for r in rows.select(corpus.passes_quality(F.col("i"), F.col("s"), None, 2.0)).collect()] == [False, True, True, False, True]


def test_cutoff_checks(spark):
    names = spark.createDataFrame([("CC-MAIN-2018-51",), ("CC-MAIN-2019-04",)], "dump string")
    corpus.check_cutoff(names, 2019)
    for bad in (names, names.limit(0), names.union(spark.createDataFrame([("x",)], "dump string"))):
        with pytest.raises(corpus.CutoffError):
            corpus.check_cutoff(bad, 2018 if bad is names else 2030)
    corpus.check_snapshot(spark.createDataFrame([("20191201.en",)], "snapshot string"), 2019)
    with pytest.raises(corpus.CutoffError):
        corpus.check_disjoint(names, names.limit(1))


def test_source_weights(spark):
    dumps = spark.createDataFrame([("CC-MAIN-2018-51",), ("CC-MAIN-2018-05",), ("CC-MAIN-2019-04",)], "dump string")
    years = spark.createDataFrame([(2018, 1.0), (2019, 3.0)], "year int, weight double")
    assert {r.dump[8:]: r.weight for r in corpus.source_weights(dumps, years).collect()} == {"2018-51": 0.125, "2018-05": 0.125, "2019-04": 0.75}
    assert {round(r.weight, 6) for r in corpus.source_weights(dumps).collect()} == {0.333333}
    for bad in (years.where("year = 2018"), years.withColumn("weight", F.lit(0.0))):
        with pytest.raises(ValueError):
            corpus.source_weights(dumps, bad)


def test_category_weights():
    assert set(corpus.category_weights(None).values()) == {1.0} and set(corpus.category_weights({"x": 1}).values()) == {1.0}
    assert sum(corpus.category_weights({"math_reasoning": 2.0}).values()) == 2.0


def test_mixing_keeps_proportions_and_all_rows(spark):
    rows = spark.range(900).select(F.col("id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("s"))
    w = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "s string, weight double")
    out = [r.s for r in corpus.mix(rows, w, "s", "id").orderBy("place", "s").collect()]
    assert len(out) == 900 and 190 <= out[:300].count("a") <= 210 and out[-200:].count("a") == 0


def test_weighted_picks_follow_weights(spark):
    w = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 0.0)], "dump string, weight double")
    n = {r.picked: r["count"] for r in corpus.pick_source(spark.range(4000), w, F.col("id")).groupBy("picked").count().collect()}
    assert set(n) == {"a", "b"} and 0.7 < n["a"] / 4000 < 0.8


def test_skill_mix_reaches_its_share(spark):
    rows = spark.range(4000).select("id", F.lit("x" * 300).alias("text"), F.when(F.col("id") % 40 == 0, "math_reasoning").alias("skill0"))
    out = corpus.skill_mix(rows, F.col("skill0"), F.col("id"), 0.2, {"math_reasoning": 1.0})
    total, extra = out.agg(F.sum("copies"), F.sum(F.col("copies") - 1)).first()
    assert 0.17 < extra / total < 0.23 and out.where("skill IS NULL AND copies > 1").isEmpty()


def test_shuffle_is_a_permutation_that_the_seed_decides(spark):
    a, b, c = ([r.id for r in corpus.shuffled(spark.range(200), F.col("id"), s).collect()] for s in (1, 1, 2))
    assert a == b != c and sorted(a) == list(range(200)) != a


def test_blocks(spark):
    docs = [(i, list(range(1, 1 + i % 7))) for i in range(50)]
    rows = spark.createDataFrame(docs, "doc_id long, ids array<int>").repartition(3)
    flat = [x for _, ids in docs if ids for x in [*ids, 0]]  # a document without tokens has no end token either
    got = {r.block_id: r.input_ids for r in corpus.pack_blocks(rows, 16).collect()}
    assert got == {k: flat[16 * k : 16 * k + 16] for k in range(len(flat) // 16)}


def test_bpe(spark):
    docs = spark.createDataFrame([(1, "low low low lower lowest é"), (2, None), (3, "")], "doc_id long, text string")
    merges = bpe.train(bpe.word_counts(docs, "doc_id"), 4)
    assert merges[0] == (b"l", b"o") and merges[1] == (b"lo", b"w")
    got = {r.doc_id: r.ids for r in bpe.encode(docs, merges).collect()}
    names = [a + b for a, b in merges]
    back = lambda ids: b"".join(bytes([i]) if i < 256 else names[i - 256] for i in ids).decode()
    assert back(got[1]) == "low low low lower lowest é" and got[2] == got[3] == [] and len(got[1]) < 27


def plain_merges(counts, n_merges):
    """Count all pairs anew for every merge."""
    words = [([bytes([b]) for b in w], n) for w, n in counts.items()]
    merges = []
    while len(merges) < n_merges:
        total = Counter()
        for parts, n in words:
            for p in zip(parts, parts[1:]):
                total[p] += n
        if not total:
            break
        best = min(total, key=lambda p: (-total[p], p))
        merges.append(best)
        words = [(bpe.merge_word(parts, best), n) for parts, n in words]
    return merges


def test_bpe_merges_equal_a_plain_count(spark, sf):
    rnd = random.Random(2)
    for letters in ("ab", "aab", "abcdef"):
        counts = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 12))).encode(): rnd.randrange(1, 9) for _ in range(60)}
        assert bpe.merges_of(counts, 1000) == plain_merges(counts, 1000)
    words = bpe.word_counts(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", sample_docs=40, sample_chars=400)
    counts = {r.word.encode(): r.n for r in words.collect()}
    got = bpe.merges_of(counts, 1000)
    assert len(got) == 1000 and got == plain_merges(counts, 1000)


def test_bpe_ids_are_those_of_plain_merging_also_where_words_are_forgotten(spark, monkeypatch):
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choice("aab") for _ in range(rnd.randrange(1, 15))) for _ in range(200)) for _ in range(20)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    merges = bpe.train(bpe.word_counts(docs, "doc_id", sample_docs=7), 30)
    assert merges == bpe.train(bpe.word_counts(docs.where("doc_id < 7"), "doc_id"), 30)
    names = [bytes([b]) for b in range(256)] + [a + b for a, b in merges]
    for r in bpe.encode(docs, merges).collect():
        want = []
        for w in re.findall(r" ?[a-z]+", texts[r.doc_id]):
            parts = [bytes([b]) for b in w.encode()]
            for m in merges:
                parts = bpe.merge_word(parts, m)
            want += parts
        assert [names[i] for i in r.ids] == want


def test_bpe_sample_is_found_among_keys_alone(spark, tmp_path):
    spark.range(40).selectExpr("id AS doc_id", "concat('word ', id) AS text").repartition(4).write.parquet(str(tmp_path / "d"))
    words = bpe.word_counts(spark.read.parquet(str(tmp_path / "d")), "doc_id", sample_docs=5)
    assert sorted(r.word for r in words.collect()) == sorted(["word", *(f" {k}" for k in range(5))])
    assert "LessThanOrEqual(doc_id,4)" in words._jdf.queryExecution().executedPlan().toString()  # texts beyond the last key aren't sorted


def test_greedy_chain(spark):
    c = spark.createDataFrame([(1,), (2,), (3,), (4,)], "uid long")
    d = spark.createDataFrame([(2, 1), (3, 2), (4, 3)], "uid long, earlier long")
    got = {r.uid: (r.accepted, r.matched) for r in duplicates.greedy(c, d).collect()}
    assert got == {1: (True, None), 2: (False, 1), 3: (True, None), 4: (False, 3)}


def test_vectors(spark):
    import numpy as np

    a, b = [3.0, 4.0, 0.0], [1.0, 2.0, 2.0]
    row = spark.createDataFrame([(a, b)], "a array<double>, b array<double>").select(
        vectors.cosine(F.col("a"), F.col("b")), vectors.symmetric_kl(vectors.log_softmax(F.col("a")), vectors.log_softmax(F.col("b"))), vectors.singular_values(F.array(*map(F.lit, [1.0, 2.0, 3.0, 4.0])), 2)).first()
    p, q = (np.exp(np.array(x)) / np.exp(np.array(x)).sum() for x in (a, b))
    assert abs(row[0] - 11 / 15) < 1e-12 and abs(row[1] - ((p - q) * np.log(p / q)).sum() / 2) < 1e-12
    assert np.allclose(row[2], np.linalg.svd(np.array([[1, 2], [3, 4.0]]), compute_uv=False))


def test_local_sources(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text("first paragraph here\nmore\n\n  \nshort\n\nsecond paragraph here")
    (tmp_path / "d" / "b.md").write_text("tiny\nbut this single line is long")
    (tmp_path / "c.jsonl").write_text('{"body": "from the body key"}\n{"prompt": "a question", "completion": "an answer"}\nbroken { line here\n\n"a bare string value"\n')
    (tmp_path / "e.json").write_text('[{"text": " ", "title": "the title is text"}, "one more string"]')
    got = {r.text for r in text_files.local_documents(spark, str(tmp_path), 10).collect()}
    assert got == {"first paragraph here\nmore", "second paragraph here", "tiny\nbut this single line is long", "from the body key", "a question\nan answer", "broken { line here", "a bare string value", "the title is text", "one more string"}


def test_fact_and_prompt_files(spark, tmp_path):
    (tmp_path / "f.json").write_text('[{"prompt": "p", "phrase": "f", "year": 2001}]')
    (tmp_path / "bad.json").write_text('[{"prompt": "p"}]')
    (tmp_path / "q.json").write_text('{"questions": ["plain", {"prompt": "rich", "category": "math"}]}')
    assert text_files.facts(spark, str(tmp_path / "f.json")).count() == 1
    with pytest.raises(ValueError):
        text_files.facts(spark, str(tmp_path / "bad.json"))
    assert {tuple(r) for r in text_files.prompt_bank(spark, str(tmp_path / "q.json")).collect()} == {("plain", "unknown"), ("rich", "math")}
    assert text_files.benchmark_path("b", 2020, False) == "b/2020/unknown.json"


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = str(tmp_path / "out")
    sinks.write_jsonl(rows, path, F.desc("k"))
    sinks.swap_in(spark.read.json(path).where("k = 1"), path)
    assert [tuple(r) for r in spark.read.json(path).collect()] == [(1, "a")]
    assert sinks.as_result(rows, "k").orderBy("k").first().result == '{"v":"a"}'
    box = spark.createDataFrame([(1, False), (2, False), (3, True)], "key int, synced boolean")
    assert {r.key for r in sinks.sync_outbox(box, lambda p: p.where("key <> 2")).where("synced").collect()} == {1, 3}


def test_shards(spark, tmp_path):
    for k in range(3):
        spark.range(k, k + 1).coalesce(1).toPandas().to_parquet(tmp_path / f"2024_{k}.parquet")
    spark.range(9, 10).toPandas().to_parquet(tmp_path / "2023_0.parquet")
    assert {r.id for r in text_files.shards(spark, str(tmp_path), "2024_", 1).collect()} == {1, 2}
