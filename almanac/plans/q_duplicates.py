"""Queries of exact and near-duplicate submissions."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions import vectors
from ..operators import duplicates, factor
from ..session import table
from .registry import query
from .views import view

MODELS = 50

# Fifty models of some layers each; every tenth model has a copy, scaled and nudged, submitted later.
_FP = f"""b AS (SELECT vec_id % {MODELS} AS uid, CAST(floor(vec_id / {MODELS}) AS BIGINT) AS layer, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vec FROM embeddings),
fp AS (SELECT uid, uid AS ord, layer, vec FROM b UNION ALL SELECT uid + 1000, uid + 1000, layer, list_transform(vec, lambda x, i: x * 1.5 + CASE WHEN i = 1 THEN 0.0005 ELSE 0 END) FROM b WHERE uid % 10 = 0)"""


def _fingerprints(spark, sf_dir):
    b = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % MODELS).alias("uid"), F.floor(F.col("vec_id") / MODELS).alias("layer"), F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    copy = b.where("uid % 10 = 0").select((F.col("uid") + 1000).alias("uid"), "layer", F.transform("vec", lambda x, i: x * 1.5 + F.when(i == 0, 0.0005).otherwise(0.0)).alias("vec"))
    return b.unionByName(copy).select("uid", F.col("uid").alias("ord"), "layer", "vec")


_PAIRS = "p AS (SELECT a.uid, b.uid AS earlier, a.layer, a.vec AS va, b.vec AS vb FROM fp a JOIN fp b ON a.layer = b.layer AND len(a.vec) = len(b.vec) AND b.ord < a.ord)"


# The first layer of every third model is a fresh bias: all zero, so its cosine with any other is 0.
_ZERO = "z AS (SELECT uid, ord, layer, CASE WHEN layer = 0 AND uid % 3 = 1 THEN list_transform(vec, lambda x: CAST(0 AS DOUBLE)) ELSE vec END AS vec FROM fp)"
_COSINE = "CASE WHEN list_sum(list_transform(va, lambda x: abs(x))) = 0 OR list_sum(list_transform(vb, lambda x: abs(x))) = 0 THEN 0 ELSE list_cosine_similarity(va, vb) END"


@query(f"""WITH {_FP}, {_ZERO}, {_PAIRS.replace('fp', 'z')}, c AS (SELECT uid, earlier, {_COSINE} AS c FROM p)
SELECT uid, earlier, round(avg(c), 6) AS cosine, avg(c) >= 0.95 AS duplicate FROM c GROUP BY ALL""")
def weight_cosine(spark, sf_dir):
    """Mean cosines over shared layers, some of them all zero."""
    zero = F.when((F.col("layer") == 0) & (F.col("uid") % 3 == 1), F.transform("vec", lambda x: F.lit(0.0))).otherwise(F.col("vec"))
    return duplicates.cosine_pairs(_fingerprints(spark, sf_dir).withColumn("vec", zero)).withColumn("cosine", F.round("cosine", 6))


_TOP = "greatest(1, CAST(floor(len({0}) * 0.25) AS INTEGER))"
_UNIT = "list_transform({0}[1:{1}], lambda x: x / (sqrt(list_dot_product({0}[1:{1}], {0}[1:{1}])) + 1e-10))"


@query(f"""WITH {_FP}, t AS (SELECT uid, ord, layer, {_UNIT.format('vec', _TOP.format('vec'))} AS vec FROM fp), {_PAIRS.replace('fp', 't')}
SELECT uid, earlier, round(avg(list_distance(va, vb)), 6) AS distance, avg(list_distance(va, vb)) < 0.001 AS duplicate FROM p GROUP BY ALL""")
def spectral_distance(spark, sf_dir):
    return duplicates.spectral_pairs(_fingerprints(spark, sf_dir)).withColumn("distance", F.round("distance", 6))


_LS = "list_transform(vec, lambda x: x - (list_max(vec) + ln(list_sum(list_transform(vec, lambda y: exp(y - list_max(vec)))))))"


@query(f"""WITH {_FP}, m AS (SELECT uid, list_max(vec) AS top, vec, ord, layer FROM fp),
z AS (SELECT uid, ord, layer, vec, top + ln(list_sum(list_transform(vec, lambda y: exp(y - top)))) AS z FROM m), l AS (SELECT uid, ord, layer, list_transform(vec, lambda x: x - z) AS vec FROM z), {_PAIRS.replace('fp', 'l')},
k AS (SELECT uid, earlier, layer % 2 AS kind, list_sum(list_transform(list_zip(va, vb), lambda s: (exp(s[1]) - exp(s[2])) * (s[1] - s[2]))) / 2 AS kl FROM p),
d AS (SELECT uid, earlier, kind, list_sort(list(kl))[CAST(floor((count(*) - 1) / 2) AS INTEGER) + 1] AS m FROM k GROUP BY ALL)
SELECT uid, earlier, round(max(m), 6) AS kl, max(m) < 0.02 AS duplicate FROM d WHERE uid <> 7 AND earlier <> 7 GROUP BY uid, earlier""")
def output_divergence(spark, sf_dir):
    """Symmetric divergence of outputs: the vectors as logits, the parity of a layer as the probe's type. One model has
    another vocabulary in one probe, so it passes beside everybody."""
    f = _fingerprints(spark, sf_dir)
    f = f.withColumn("vec", F.when((F.col("uid") == 7) & (F.col("layer") == 1), F.slice("vec", 1, 60)).otherwise(F.col("vec")))
    logits = f.select("uid", "ord", (F.col("layer") % 2).alias("probe_type"), F.col("layer").alias("probe_idx"), F.col("vec").alias("logits"))
    return duplicates.output_pairs(logits, 0.02).withColumn("kl", F.round("kl", 6))


@query(f"""WITH {_FP}, {_PAIRS}, e AS (SELECT uid, earlier FROM p GROUP BY ALL HAVING avg(list_cosine_similarity(va, vb)) >= 0.95), c AS (SELECT DISTINCT uid FROM fp)
SELECT c.uid, count(earlier) = 0 AS accepted, CAST(min(CAST(earlier AS STRING)) AS BIGINT) AS matched FROM c LEFT JOIN e ON c.uid = e.uid AND earlier NOT IN (SELECT uid FROM e) GROUP BY c.uid""")
def greedy_dedup(spark, sf_dir):
    """Candidates in order against accepted ones (here chains have length one, which the SQL relies on)."""
    f = _fingerprints(spark, sf_dir)
    return duplicates.greedy(f.select("uid").distinct(), duplicates.cosine_pairs(f).where("duplicate"))


@query("""WITH o AS (SELECT content, min(struct_pack(t := coalesce(snapshot_at, '9999'), u := uid)).u AS owner FROM submissions GROUP BY content)
SELECT event_id, uid, sha256(content) AS sha, owner, uid <> owner AS duplicate FROM submissions JOIN o USING (content)""", ("submissions",))
def exact_duplicates(spark, sf_dir):
    """Who submitted a content first owns it; missing times count last."""
    s = duplicates.exact_duplicates(view(spark, sf_dir, "submissions"))
    return s.select("event_id", "uid", F.sha2(F.col("content").cast("binary"), 256).alias("sha"), "owner", "duplicate")


@query("SELECT text, min(doc_id) AS first, count(*) AS n FROM documents GROUP BY text")
def keep_first_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("text").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))


@query("""WITH m AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
g AS (SELECT vec_id, list_sum(list_transform(range(8), lambda k: v[k * 8 + i + 1] * v[k * 8 + j + 1])) AS x FROM m, range(8) AS a(i), range(8) AS b(j))
SELECT vec_id, round(list_sum(list_transform(v, lambda x: x * x)), 4) AS squares, round(f, 3) AS fourth_powers, CAST(8 AS INTEGER) AS n FROM m JOIN (SELECT vec_id, sum(x * x) AS f FROM g GROUP BY vec_id) USING (vec_id)""")
def singular_values(spark, sf_dir):
    """Spectra of the vectors as 8 by 8 matrices M, in Arrow batches: their squares sum up to the trace of M'M, their fourth powers to that of its square."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", vectors.singular_values(F.col("embedding"), 8).alias("s"))
    power = lambda k: F.reduce("s", F.lit(0.0), lambda a, x: a + F.pow(x, F.lit(k)))
    return v.select("vec_id", F.round(power(2), 4).alias("squares"), F.round(power(4), 3).alias("fourth_powers"), F.size("s").alias("n"))


@query(f"""WITH {_FP}, t AS (SELECT uid, ord, layer, {_UNIT.format('vec', _TOP.format('vec'))} AS vec FROM fp WHERE uid % 7 <> 3 OR layer > 2), {_PAIRS.replace('fp', 't')}
SELECT uid, earlier, round(avg(list_distance(va, vb)), 9) AS distance FROM p GROUP BY ALL HAVING avg(list_distance(va, vb)) < 0.001""")
def spectral_duplicates(spark, sf_dir):
    """Spectral duplicates among models that don't all have the same layers, through pivots and not through all pairs."""
    f = _fingerprints(spark, sf_dir).where("uid % 7 <> 3 OR layer > 2")
    return duplicates.spectral_duplicates(f).withColumn("distance", F.round("distance", 9))


@query("""WITH v AS (SELECT label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
g AS (SELECT label, i, j, sum(v[i] * v[j]) AS x FROM v, range(1, 65) AS a(i), range(1, 65) AS b(j) GROUP BY ALL)
SELECT label, round(sum(CASE WHEN i = j THEN x END), 6) AS squares, round(sum(x * x), 4) AS fourth_powers, CAST(least(64, any_value(n)) AS INTEGER) AS n FROM g JOIN (SELECT label AS l, count(*) AS n FROM embeddings GROUP BY 1) ON l = label GROUP BY label""")
def tall_spectra(spark, sf_dir):
    """Spectra of all vectors of a label as one tall matrix M: their squares sum up to the trace of M'M, their fourth powers to that of its square."""
    s = factor.spectra(table(spark, sf_dir, "embeddings"), "label", "embedding", 64)
    power = lambda k: F.reduce("spectrum", F.lit(0.0), lambda a, x: a + F.pow(x, F.lit(k)))
    return s.select("label", F.round(power(2), 6).alias("squares"), F.round(power(4), 4).alias("fourth_powers"), F.size("spectrum").alias("n"))
