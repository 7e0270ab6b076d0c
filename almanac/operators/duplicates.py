"""Exact and near-duplicate tests of submissions.

Candidates are compared with earlier ones only. The comparison joins on layer (or probe) and
shape, so it is an equi-join; each pair of candidates meets once per layer they share. That
is quadratic in the candidates by definition of the tests, and candidates are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import OUTPUT_KL, SPECTRUM_DISTANCE, WEIGHT_COSINE
from ..functions.vectors import cosine, distance, log_softmax, norm, symmetric_kl_known, top_prefix, with_probability
from ..session import shared_folder
from .rank import lower_median


def first_submitters(rows: DataFrame, content: str = "content", uid: str = "uid", time: str = "snapshot_at") -> DataFrame:
    """(content, owner): who submitted a content first; missing times last, then the smaller uid. An aggregate, no sort of a group."""
    return rows.groupBy(content).agg(F.min(F.struct(F.coalesce(F.col(time), F.lit("9999")).alias("t"), F.col(uid).alias("u")))["u"].alias("owner"))


def exact_duplicates(rows: DataFrame, content: str = "content", uid: str = "uid", time: str = "snapshot_at") -> DataFrame:
    """``rows`` with the content's sha256 owner and whether it is somebody else's."""
    owners = first_submitters(rows, content, uid, time)
    return rows.join(owners, content).withColumn("duplicate", F.col(uid) != F.col("owner"))


def _earlier(rows: DataFrame, on: list[str], value: str) -> DataFrame:
    a = rows.select(F.col("uid").alias("uid"), F.col("ord").alias("_oa"), *on, F.col(value).alias("_a"))
    b = rows.select(F.col("uid").alias("earlier"), F.col("ord").alias("_ob"), *on, F.col(value).alias("_b"))
    return a.join(b, on).where(F.col("_ob") < F.col("_oa"))


def spectral_pairs(layers: DataFrame, threshold: float = SPECTRUM_DISTANCE) -> DataFrame:
    """(uid, earlier, distance, duplicate) of rows (uid, ord, layer, vec): the mean distance of the leading spectra over shared layers of one size."""
    rows = layers.withColumn("n", F.size("vec")).withColumn("top", top_prefix(F.col("vec")))
    pairs = _earlier(rows, ["layer", "n"], "top").groupBy("uid", "earlier").agg(F.avg(distance(F.col("_a"), F.col("_b"))).alias("distance"))
    return pairs.withColumn("duplicate", F.col("distance") < threshold)


#: Pivots of each (layer, size); the first two make the cells that candidates meet in.
PIVOTS = 4
#: What rounding may add to a bound.
SLACK = 1e-9


def spectral_candidates(layers: DataFrame, threshold: float = SPECTRUM_DISTANCE) -> DataFrame:
    """(uid, earlier): every pair that may be a spectral duplicate, found without comparing all pairs.

    A mean distance below the threshold has a layer below it. The distance is a metric, so there the two
    lie at distances from any pivot that differ by less than the threshold: both fall into the same or neighbouring cells
    of that width for two pivots, in which they meet, and further pivots prune before any vector is looked at.
    """
    rows = _leading(layers)
    pivots = rows.groupBy("layer", "n").agg(*(F.min_by("top", F.xxhash64("uid", F.lit(k))).alias(f"_p{k}") for k in range(PIVOTS)))
    away = F.array(*(distance(F.col("top"), F.col(f"_p{k}")) for k in range(PIVOTS)))
    cell = lambda k: F.floor(F.get("_d", k) / threshold)
    placed = rows.join(pivots, ["layer", "n"]).select("uid", "ord", "layer", "n", away.alias("_d")).select("*", cell(0).alias("_c0"), cell(1).alias("_c1"))
    near = lambda c: F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1)).alias(c)
    others = placed.select(F.col("uid").alias("earlier"), F.col("ord").alias("_ob"), "layer", "n", F.col("_d").alias("_e"), near("_c0"), "_c1").select("earlier", "_ob", "layer", "n", "_e", "_c0", near("_c1"))
    within = F.forall(F.zip_with("_d", "_e", lambda x, y: F.abs(x - y) < threshold + SLACK), lambda ok: ok)
    return placed.join(others, ["layer", "n", "_c0", "_c1"]).where((F.col("_ob") < F.col("ord")) & within).select("uid", "earlier").distinct()


def _leading(layers: DataFrame) -> DataFrame:
    return layers.withColumn("n", F.size("vec")).withColumn("top", top_prefix(F.col("vec")))


def spectral_duplicates(layers: DataFrame, threshold: float = SPECTRUM_DISTANCE) -> DataFrame:
    """(uid, earlier, distance): the duplicates of ``spectral_pairs``, exactly, from the candidates that the pivots leave."""
    rows = _leading(layers)
    a = rows.select("uid", "layer", "n", F.col("top").alias("_a"))
    b = rows.select(F.col("uid").alias("earlier"), "layer", "n", F.col("top").alias("_b"))
    met = spectral_candidates(layers, threshold).join(a, "uid").join(b, ["earlier", "layer", "n"])
    return met.groupBy("uid", "earlier").agg(F.avg(distance(F.col("_a"), F.col("_b"))).alias("distance")).where(F.col("distance") < threshold)


def cosine_pairs(layers: DataFrame, threshold: float = WEIGHT_COSINE) -> DataFrame:
    """(uid, earlier, cosine, duplicate): the mean cosine over shared layers of one size greater than one."""
    rows = layers.withColumn("n", F.size("vec")).where("n > 1").withColumn("v", F.struct("vec", norm(F.col("vec")).alias("norm")))
    a, b = F.col("_a"), F.col("_b")
    pairs = _earlier(rows, ["layer", "n"], "v").groupBy("uid", "earlier").agg(F.avg(cosine(a["vec"], b["vec"], a["norm"], b["norm"])).alias("cosine"))
    return pairs.withColumn("duplicate", F.col("cosine") >= threshold)


def output_pairs(logits: DataFrame, threshold: float = OUTPUT_KL) -> DataFrame:
    """(uid, earlier, kl, duplicate) of rows (uid, ord, probe_type, probe_idx, logits): the largest over probe types of the lower median divergence.

    One probe with unlike vocabularies makes the whole pair pass: it doesn't occur.
    """
    rows = logits.withColumn("lp", with_probability(log_softmax(F.col("logits"))))
    met = _earlier(rows, ["probe_type", "probe_idx"], "lp")
    alike = F.size("_a") == F.size("_b")
    kl = met.select("uid", "earlier", "probe_type", (~alike).alias("_unlike"), F.when(alike, symmetric_kl_known(F.col("_a"), F.col("_b"))).alias("kl"))
    med = kl.groupBy("uid", "earlier", "probe_type").agg(F.bool_or("_unlike").alias("_unlike"), lower_median("kl").alias("m"))
    pairs = med.groupBy("uid", "earlier").agg(F.bool_or("_unlike").alias("_unlike"), F.max("m").alias("kl")).where(~F.col("_unlike")).drop("_unlike")
    return pairs.withColumn("duplicate", F.col("kl") < threshold)


def greedy(candidates: DataFrame, duplicates: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """(uid, accepted, matched): candidates in order, each rejected if it duplicates an earlier accepted one.

    ``duplicates`` has (uid, earlier). A round decides every candidate whose earlier matches are all
    decided; rounds are as many as the longest chain, and each is cut off by a checkpoint.
    The reported match is the accepted one with the least name.
    """
    shared_folder(candidates.sparkSession)
    edges = duplicates.select("uid", "earlier").distinct().checkpoint()
    state = candidates.select("uid", F.lit(None).cast("boolean").alias("accepted"), F.lit(None).cast(candidates.schema["uid"].dataType).alias("matched"))
    for _ in range(most_rounds):
        known = state.select(F.col("uid").alias("_e"), F.col("accepted").alias("_ok"))
        seen = edges.join(known, F.col("earlier") == F.col("_e")).groupBy("uid").agg(
            F.count_if(F.col("_ok").isNull()).alias("_open"), F.min(F.when(F.col("_ok"), F.col("earlier").cast("string"))).alias("_match"))
        joined = state.join(seen, "uid", "left")
        match = F.col("_match").cast(candidates.schema["uid"].dataType)
        now = F.when(match.isNotNull(), False).when(F.coalesce("_open", F.lit(0)) == 0, True)
        state = joined.select("uid", F.coalesce("accepted", now).alias("accepted"), F.when(F.coalesce("_open", F.lit(0)) == 0, match).alias("matched")).checkpoint()
        if state.where("accepted IS NULL").isEmpty():
            return state
    raise RuntimeError(f"candidates are undecided after {most_rounds} rounds")


def any_test(layers: DataFrame, logits: DataFrame, spectrum: float = SPECTRUM_DISTANCE, weight: float = WEIGHT_COSINE, output: float = OUTPUT_KL) -> DataFrame:
    """(uid, earlier, distance, cosine, kl, duplicate): the three tests of each pair, any of which makes a duplicate.

    A test that a pair has nothing in common for is NULL and passes.
    """
    on = ["uid", "earlier"]
    tests = [spectral_pairs(layers, spectrum), cosine_pairs(layers, weight), output_pairs(logits, output)]
    wide = None
    for k, t in enumerate(tests):
        t = t.withColumnRenamed("duplicate", f"_d{k}")
        wide = t if wide is None else wide.join(t, on, "full")
    return wide.select(*on, "distance", "cosine", "kl", (F.coalesce("_d0", F.lit(False)) | F.coalesce("_d1", F.lit(False)) | F.coalesce("_d2", F.lit(False))).alias("duplicate"))


def greedy_any_test(layers: DataFrame, logits: DataFrame, spectrum: float = SPECTRUM_DISTANCE, weight: float = WEIGHT_COSINE, output: float = OUTPUT_KL) -> DataFrame:
    """(uid, accepted, matched, distance, cosine, kl): candidates in order, rejected by any test against an accepted earlier one.

    The match with the least name is reported with its three figures.
    """
    shared_folder(layers.sparkSession)
    pairs = any_test(layers, logits, spectrum, weight, output).checkpoint()  # three figures a pair, asked for twice
    decided = greedy(layers.select("uid").unionByName(logits.select("uid")).distinct(), pairs.where("duplicate"))
    found = pairs.withColumnsRenamed({"uid": "_u", "earlier": "_e"}).drop("duplicate")
    return decided.join(found, (F.col("uid") == F.col("_u")) & (F.col("matched") == F.col("_e")), "left").drop("_u", "_e")
