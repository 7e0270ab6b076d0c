"""Tall spectra, pivots and buffered shuffles."""

import numpy as np
import pytest
from almanac.operators import corpus, duplicates, factor
from pyspark.sql import functions as F


def test_a_tall_matrix_over_many_partitions_equals_numpy(spark):
    rows = spark.range(0, 100_000, 1, 32).select(F.lit("m").alias("name"), F.array(*(F.sin((F.col("id") + 1) * (k + 1) * 0.37) * (10.0 ** -(k / 9)) for k in range(64))).alias("v"))
    x = np.sin(np.outer(np.arange(1, 100_001), np.arange(1, 65)) * 0.37) * 10.0 ** -(np.arange(64) / 9)
    want = np.linalg.svd(x, compute_uv=False)
    for fan in (16, 3):
        got = np.array(factor.spectra(rows, "name", "v", 64, fan).first().spectrum)
        assert got.shape == (64,) and np.abs(got / want - 1).max() < 1e-8


def test_many_matrices_few_rows_nulls_and_other_sizes(spark, monkeypatch):
    monkeypatch.setattr(factor, "HELD", 3)
    rng = np.random.default_rng(1)
    rows = [(None if k == 0 else k, rng.normal(size=5).tolist()) for k in range(9) for _ in range(1 + 2 * k)]
    df = spark.createDataFrame([*rows, (3, None)], "m long, v array<double>").repartition(6)
    got = {r.m: r.spectrum for r in factor.spectra(df, "m", "v", 5, 2).collect()}
    assert len(got) == 9
    for m in got:
        want = np.linalg.svd(np.array([v for k, v in rows if k == m]), compute_uv=False)
        assert np.allclose(got[m], want)
    assert factor.spectra(df.limit(0), "m", "v", 5).count() == 0
    with pytest.raises(Exception, match="4 columns"):
        factor.spectra(df, "m", "v", 4).collect()


def test_pivots_find_the_duplicates_of_all_pairs_and_compare_few(spark):
    rng = np.random.default_rng(2)
    models = []
    for uid in range(90):
        layers = {k: rng.normal(size=24) for k in range(4) if not (uid % 5 == 0 and k == 2)}
        models.append((uid, layers))
    for uid in range(0, 90, 7):  # near copies, some without a layer, some just beyond the threshold
        layers = {k: v * 3 + (0 if uid % 2 else 2e-3) * np.eye(24)[0] for k, v in models[uid][1].items() if not (uid % 3 == 0 and k == 1)}
        models.append((1000 + uid, layers))
    df = spark.createDataFrame([(uid, uid, k, v.tolist()) for uid, layers in models for k, v in layers.items()], "uid long, ord long, layer int, vec array<double>")
    pairs = duplicates.spectral_pairs(df)
    want = {(r.uid, r.earlier): round(r.distance, 9) for r in pairs.where("duplicate").collect()}
    got = {(r.uid, r.earlier): round(r.distance, 9) for r in duplicates.spectral_duplicates(df).collect()}
    assert got == want and len(want) >= 6
    assert duplicates.spectral_candidates(df).count() < 0.05 * pairs.count()
    assert duplicates.spectral_duplicates(df.limit(0)).count() == 0


def test_a_buffered_shuffle_keeps_its_rows_and_its_order(spark):
    rows = spark.range(0, 3000, 1, 3).withColumn("t", F.concat(F.lit("text "), F.col("id").cast("string")))
    get = lambda *a: [r.id for r in corpus.buffered_shuffle(rows, *a).collect()]
    a = get(100, 42, "dump", 0)
    assert sorted(a) == list(range(3000)) and a == get(100, 42, "dump", 0) and a != get(100, 42, "dump", 1) and a != list(range(3000))
    at = {x: i for i, x in enumerate(a)}
    assert all(at[x] >= x - 100 for x in range(3000)) and sorted(a[:1000]) == list(range(1000))  # within partitions, never early by more than the buffer
    assert get(1, 42) == list(range(3000)) and corpus.buffered_shuffle(rows.limit(0), 5, 1).count() == 0
