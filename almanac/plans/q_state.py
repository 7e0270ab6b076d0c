"""Queries of scoring from token probabilities, stored tables, duel inputs, benchmarks, counters and stops."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..functions.fixed import DEFAULTS
from ..operators import corpus, duplicates, rank
from ..session import shared_folder, table
from ..sources import sinks, store, text_files
from . import build
from .registry import query
from .views import view

# A vector as logits over its places, four tokens an item; every seventh item has no tokens.
_LOGITS = """t AS (SELECT vec_id, CAST(floor(vec_id / 4) AS BIGINT) AS item, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, CAST(vec_id * 7 % 64 AS INTEGER) AS expected FROM embeddings),
m AS (SELECT *, list_max(v) AS top FROM t WHERE item % 7 <> 0),
p AS (SELECT item, exp(v[expected + 1] - top) / list_sum(list_transform(v, lambda y: exp(y - top))) AS p FROM m),
s AS (SELECT i.item, coalesce(sum(ln(p + 1e-10)), 0) AS score FROM (SELECT DISTINCT item FROM t) i LEFT JOIN p USING (item) GROUP BY i.item)"""


def _tokens(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 4).alias("item"), F.col("embedding").alias("logits"), (F.col("vec_id") * 7 % 64).cast("int").alias("expected"))
    return e.select("item").distinct(), e.where("item % 7 <> 0")


@query(f"WITH {_LOGITS} SELECT item, round(score, 6) AS score FROM s")
def sequence_log_prob(spark, sf_dir):
    """Sum of log-probabilities of each item's expected tokens; an item without tokens scores 0."""
    return rank.sequence_log_probs(*_tokens(spark, sf_dir), ["item"]).select("item", F.round("score", 6).alias("score"))


@query(f"""WITH {_LOGITS}, k AS (SELECT item % 5 AS uid, CAST(2020 + item % 2 AS INTEGER) AS year, CASE WHEN item % 3 = 0 THEN 'unknown' ELSE 'known' END AS kind, CASE WHEN item % 4 = 0 THEN 5 ELSE 1 END AS weight, score FROM s),
g AS (SELECT uid, year, kind, list_sort(list(score))[CAST(floor(count(*) / 2) AS INTEGER) + 1] AS median, CAST(sum(CASE WHEN score > -11.51 THEN weight ELSE 0 END) AS DOUBLE) / sum(weight) AS ratio FROM k GROUP BY ALL),
w AS (SELECT uid, year, coalesce(max(median) FILTER (kind = 'known'), -20) AS km, coalesce(max(median) FILTER (kind = 'unknown'), -20) AS um,
    coalesce(bool_or(ratio > 0.1) FILTER (kind = 'known'), false) AS known_ok, NOT coalesce(bool_or(ratio > 0.3) FILTER (kind = 'unknown'), false) AS unknown_ok FROM g GROUP BY uid, year)
SELECT uid, year, round(CASE WHEN known_ok AND unknown_ok THEN um - km ELSE 0 END, 6) AS score, known_ok, unknown_ok FROM w""")
def dated_prompt_leak(spark, sf_dir):
    """The leak test from token probabilities to a score by year: known and unknown items, weights, gates and medians."""
    items, tokens = _tokens(spark, sf_dir)
    asked = items.select("item", (F.col("item") % 5).alias("uid"), (2020 + F.col("item") % 2).cast("int").alias("year"), F.when(F.col("item") % 3 == 0, "unknown").otherwise("known").alias("kind"), F.when(F.col("item") % 4 == 0, 5).otherwise(1).alias("weight"))
    scored = build.leak_test(asked, tokens, ["item"], {**DEFAULTS, "known_threshold": 0.1, "leak_threshold": 0.3})
    return scored.withColumn("score", F.round("score", 6))


@query("""WITH c AS (SELECT user_id % 5 AS uid, CAST(2020 + event_id % 2 AS INTEGER) AS year, event_id % 50 AS prompt_idx, min(event_type) AS text FROM events WHERE user_id % 5 <> 2 OR event_id % 50 > 8 GROUP BY ALL),
p AS (SELECT DISTINCT CAST(2020 + event_id % 2 AS INTEGER) AS year, event_id % 50 AS prompt_idx, 'prompt ' || CAST(event_id % 50 AS STRING) AS prompt FROM events WHERE event_id % 50 % 9 <> 4),
y AS (SELECT DISTINCT uid, year FROM c),
d AS (SELECT a.uid AS uid_a, b.uid AS uid_b, a.year, p.prompt_idx, prompt, coalesce(ca.text, '') AS ta, coalesce(cb.text, '') AS tb,
    ('0x' || substr(md5('swap|' || concat_ws('|', a.uid, b.uid, a.year, p.prompt_idx)), 1, 8))::UBIGINT < 2147483648 AS swap FROM y a JOIN y b ON a.uid < b.uid AND a.year = b.year JOIN p ON p.year = a.year
    LEFT JOIN c ca ON ca.uid = a.uid AND ca.year = a.year AND ca.prompt_idx = p.prompt_idx LEFT JOIN c cb ON cb.uid = b.uid AND cb.year = a.year AND cb.prompt_idx = p.prompt_idx)
SELECT uid_a, uid_b, year, prompt_idx, prompt, swap, CASE WHEN swap THEN tb ELSE ta END AS first, CASE WHEN swap THEN ta ELSE tb END AS second FROM d""")
def duel_inputs(spark, sf_dir):
    """Completions of both players joined by year and prompt, in drawn order; one player left some prompts out."""
    e = table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 5).alias("uid"), (2020 + F.col("event_id") % 2).cast("int").alias("year"), (F.col("event_id") % 50).alias("prompt_idx"))
    c = e.where("uid <> 2 OR prompt_idx > 8").groupBy("uid", "year", "prompt_idx").agg(F.min("event_type").alias("text"))
    prompts = e.where("prompt_idx % 9 <> 4").select("year", "prompt_idx", F.concat(F.lit("prompt "), F.col("prompt_idx").cast("string")).alias("prompt")).distinct()
    return rank.duel_inputs(c, rank.pairs(c.select("uid").distinct(), "uid"), prompts)


_YEARS = [1996, 1998, 2000]


@query(f"""WITH f AS (SELECT o_orderstatus AS prompt, o_orderpriority AS phrase, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
s AS (SELECT CAST(k AS INTEGER) AS year, CASE WHEN y <= k THEN 'known' ELSE 'unknown' END AS kind, y, CASE WHEN y = k THEN 5 ELSE 1 END AS weight FROM f, unnest({_YEARS}) AS t(k))
SELECT year, kind, y AS fact_year, count(*) AS n, CAST(sum(weight) AS BIGINT) AS weight FROM s GROUP BY ALL""")
def benchmarks_by_year(spark, sf_dir):
    """Known and unknown facts of every evaluated year, those of the year itself heavier."""
    facts = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("prompt"), F.col("o_orderpriority").alias("phrase"), F.year(F.col("o_orderdate").cast("date")).alias("year"))
    return rank.benchmarks(facts, _YEARS).groupBy("year", "kind", "fact_year").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))


# Every tenth model has three successors, each turned by an angle whose cosine passes the test against the one
# before it only: so the second is rejected, the third accepted, the fourth rejected.
_COS, _SIN = 0.96, 0.28
_TURNS = [(1.0, 0.0), (0.96, 0.28), (0.96 * 0.96 - 0.28 * 0.28, 2 * 0.96 * 0.28), (0.96 * (0.96 * 0.96 - 0.28 * 0.28) - 0.28 * 2 * 0.96 * 0.28, 0.28 * (0.96 * 0.96 - 0.28 * 0.28) + 0.96 * 2 * 0.96 * 0.28)]
_CHAIN = "b AS (SELECT vec_id % 50 AS uid, CAST(floor(vec_id / 50) AS BIGINT) AS layer, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vec FROM embeddings), fp AS (" + " UNION ALL ".join(
    f"SELECT uid + {1000 * k} AS uid, uid + {1000 * k} AS ord, layer, " + ("vec" if not k else f"list_transform(vec, lambda x, i: {c!r} * x + {s!r} * CASE WHEN i % 2 = 1 THEN -vec[i + 1] ELSE vec[i - 1] END)") + " AS vec FROM b" + (" WHERE uid % 10 = 0" if k else "")
    for k, (c, s) in enumerate(_TURNS)) + ")"


def _turned(c, s):
    return F.transform("vec", lambda x, i: c * x + s * F.when(i % 2 == 0, -F.get("vec", i + 1)).otherwise(F.get("vec", i - 1)))


def _chain(spark, sf_dir):
    b = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 50).alias("uid"), F.floor(F.col("vec_id") / 50).alias("layer"), F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    out = b
    for k, (c, s) in enumerate(_TURNS[1:], 1):
        out = out.unionByName(b.where("uid % 10 = 0").select((F.col("uid") + 1000 * k).alias("uid"), "layer", _turned(c, s).alias("vec")))
    return out.select("uid", F.col("uid").alias("ord"), "layer", "vec")


@query(f"""WITH RECURSIVE {_CHAIN}, pr AS (SELECT a.uid, b.uid AS earlier, a.layer, a.vec AS va, b.vec AS vb FROM fp a JOIN fp b ON a.layer = b.layer AND b.ord < a.ord),
u AS (SELECT uid, layer, list_transform(vec[1:16], lambda x: x / (sqrt(list_dot_product(vec[1:16], vec[1:16])) + 1e-10)) AS top, list_max(vec) + ln(list_sum(list_transform(vec, lambda y: exp(y - list_max(vec))))) AS z FROM fp),
q AS (SELECT pr.uid, pr.earlier, pr.layer, list_cosine_similarity(va, vb) AS c, list_distance(x.top, y.top) AS d,
    list_sum(list_transform(list_zip(va, vb), lambda s: (exp(s[1] - x.z) - exp(s[2] - y.z)) * ((s[1] - x.z) - (s[2] - y.z)))) / 2 AS k FROM pr JOIN u x ON x.uid = pr.uid AND x.layer = pr.layer JOIN u y ON y.uid = pr.earlier AND y.layer = pr.layer),
kl AS (SELECT uid, earlier, max(m) AS kl FROM (SELECT uid, earlier, layer % 2 AS kind, list_sort(list(k))[CAST(floor((count(*) - 1) / 2) AS INTEGER) + 1] AS m FROM q GROUP BY ALL) GROUP BY ALL),
t AS (SELECT uid, earlier, avg(d) AS distance, avg(c) AS cosine, any_value(kl) AS kl FROM q JOIN kl USING (uid, earlier) GROUP BY uid, earlier),
e AS (SELECT uid, list(earlier) AS es FROM t WHERE distance < 0.001 OR cosine >= 0.95 OR kl < 0.0005 GROUP BY uid),
o AS (SELECT c.uid, coalesce(es, []::BIGINT[]) AS es, row_number() OVER (ORDER BY c.uid) AS i FROM (SELECT DISTINCT uid FROM fp) c LEFT JOIN e USING (uid)),
g(i, taken) AS (SELECT CAST(0 AS BIGINT), []::BIGINT[] UNION ALL SELECT o.i, CASE WHEN len(list_intersect(taken, o.es)) = 0 THEN list_append(taken, o.uid) ELSE taken END FROM g JOIN o ON o.i = g.i + 1),
f AS (SELECT o.uid, len(list_intersect(taken, o.es)) = 0 AS accepted, CAST(list_min(list_transform(list_intersect(taken, o.es), lambda x: CAST(x AS STRING))) AS BIGINT) AS matched FROM o JOIN g ON g.i = o.i - 1)
SELECT f.uid, accepted, matched, round(distance, 6) AS distance, round(cosine, 6) AS cosine, round(kl, 6) AS kl FROM f LEFT JOIN t ON t.uid = f.uid AND t.earlier = f.matched""")
def greedy_any_test(spark, sf_dir):
    """Candidates against accepted ones by all three tests, with chains of three."""
    f = _chain(spark, sf_dir)
    logits = f.select("uid", "ord", (F.col("layer") % 2).alias("probe_type"), F.col("layer").alias("probe_idx"), F.col("vec").alias("logits"))
    g = duplicates.greedy_any_test(f, logits, output=0.0005)
    return g.select("uid", "accepted", "matched", *(F.round(c, 6).alias(c) for c in ("distance", "cosine", "kl")))


def _store(spark):
    return store.result_store(spark, f"{shared_folder(spark)}/results-{uuid.uuid4().hex}")


@query("""SELECT vec_id % 20 AS uid, CAST(floor(vec_id / 20) AS BIGINT) AS layer, CASE WHEN vec_id % 20 < 5 THEN CAST(-1 AS DOUBLE) ELSE round(CAST(embedding[1] AS DOUBLE), 6) END AS first, CASE WHEN vec_id % 20 < 5 THEN 1 ELSE len(embedding) END AS n FROM embeddings WHERE vec_id % 3 = 0""")
def stored_spectra(spark, sf_dir):
    """Spectra of two rounds, some replaced, in a keyed table; those of the second round are read back."""
    s = _store(spark)
    v = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("vec_id") % 20).alias("uid"), F.floor(F.col("vec_id") / 20).alias("layer"), F.transform("embedding", lambda x: x.cast("double")).alias("spectrum"))
    store.save_spectra(s, v.where("vec_id % 2 = 0"), 1)
    store.save_spectra(s, v.where("vec_id % 3 = 0"), 2)
    store.save_spectra(s, v.where("vec_id % 3 = 0 AND uid < 5").withColumn("spectrum", F.array(F.lit(-1.0))), 2)
    return store.spectra_of(s, 2).select("uid", "layer", F.round(F.get("spectrum", 0), 6).alias("first"), F.size("spectrum").cast("long").alias("n"))


@query("""WITH e AS (SELECT user_id AS uid, CAST(2020 + event_id % 3 AS INTEGER) AS year, round(max(value), 2) AS score FROM events GROUP BY ALL)
SELECT uid, year, CASE WHEN uid % 4 = 0 THEN score + 1 ELSE score END AS score, CASE WHEN uid % 4 = 0 THEN false ELSE uid % 3 = 0 END AS synced FROM e WHERE NOT (uid % 4 <> 0 AND uid % 7 = 3)""")
def stored_evaluations(spark, sf_dir):
    """Evaluations saved, marked as synced, evaluated again (which resets the mark), and some deleted."""
    s = _store(spark)
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("uid"), (2020 + F.col("event_id") % 3).cast("int").alias("year")).agg(F.round(F.max("value"), 2).alias("score")).withColumns({"round": F.lit(1), "synced": F.lit(False)})
    s.upsert("evaluations", e)
    s.upsert("evaluations", s.read("evaluations").where("uid % 3 = 0").withColumn("synced", F.lit(True)))
    s.upsert("evaluations", e.where("uid % 4 = 0").withColumn("score", F.col("score") + 1))
    s.insert_ignore("evaluations", e.withColumn("score", F.lit(-1.0)))
    s.delete("evaluations", "uid % 4 <> 0 AND uid % 7 = 3")
    return s.read("evaluations").select("uid", "year", "score", "synced")


@query("SELECT doc_id, text FROM documents WHERE length(text) >= 500 ORDER BY doc_id LIMIT 100")
def max_rows_stop(spark, sf_dir):
    """A scan that stops at a number of kept rows (the stop is the feature)."""
    return corpus.first_rows(text_files.scan(table(spark, sf_dir, "documents"), "text", 500), ["doc_id"], 100).select("doc_id", "text")


_SEED = "CAST(('0x' || substr(sha256('42|' || dump || '|' || CAST(cycle AS STRING)), 9, 8))::UBIGINT & 2147483647 AS BIGINT)"


@query(f"SELECT doc_id, dump, cycle, row_number() OVER (PARTITION BY dump, cycle ORDER BY md5(CAST({_SEED} AS STRING) || '|' || CAST(doc_id AS STRING)), doc_id) - 1 AS pos FROM crawl_docs, range(2) AS r(cycle)", ("crawl_docs",))
def seeded_shuffle(spark, sf_dir):
    """Every crawl and cycle in the order that its own seed gives."""
    d = view(spark, sf_dir, "crawl_docs").select("doc_id", "dump").withColumn("cycle", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(1).cast("long"))))
    return corpus.seeded_shuffle(d, "dump", "cycle", "doc_id").select("doc_id", "dump", "cycle", "pos")


@query("SELECT CASE event_id % 5 WHEN 3 THEN 'bad' WHEN 4 THEN 'blank' ELSE 'kept' END AS state, count(*) AS n, CAST(coalesce(sum(CASE WHEN event_id % 5 < 3 THEN user_id END), 0) AS BIGINT) AS users FROM events GROUP BY ALL")
def jsonl_counters(spark, sf_dir):
    """JSON lines with malformed and blank ones among them, all counted by state."""
    e = table(spark, sf_dir, "events")
    line = F.when(F.col("event_id") % 5 == 3, '{"user_id": 1, broken').when(F.col("event_id") % 5 == 4, "  ").otherwise(F.to_json(F.struct("user_id", "event_type")))
    rows = text_files.parsed_lines(e.select(line.alias("value")), "user_id long, event_type string")
    return rows.groupBy(F.col("_state").alias("state")).agg(F.count("*").alias("n"), F.coalesce(F.sum("user_id"), F.lit(0)).alias("users"))


@query("""WITH v AS (SELECT category, CASE WHEN swap AND raw = 'a' THEN 'b' WHEN swap AND raw = 'b' THEN 'a' ELSE raw END AS x FROM verdicts)
SELECT printf('%-24s %4d %12d %12d %6d', category, count(*), count(*) FILTER (x = 'a'), count(*) FILTER (x = 'b'), count(*) FILTER (x = 'tie')) AS line FROM v GROUP BY category""", ("verdicts",))
def category_report(spark, sf_dir):
    """Lines of the duel report by category."""
    return sinks.category_report(rank.tally(view(spark, sf_dir, "verdicts"), ["category"]))


_SCAN = """r AS (SELECT doc_id, source FROM documents WHERE n_chars >= 300), sz AS (SELECT source, count(*) AS size FROM r GROUP BY source),
w AS (SELECT source, CASE source WHEN 'src1' THEN 3.0 WHEN 'src2' THEN 0.0 ELSE 1.0 END AS weight FROM sz), p AS (SELECT * FROM w WHERE weight > 0),
c AS (SELECT source, sum(weight) OVER (ORDER BY source) / sum(weight) OVER () AS hi, (sum(weight) OVER (ORDER BY source) - weight) / sum(weight) OVER () AS lo FROM p),
u AS (SELECT turn, ('0x' || substr(md5('42|' || CAST(turn AS STRING)), 1, 8))::UBIGINT / 4294967296.0 AS u FROM range(80) AS t(turn)),
d AS (SELECT turn, source, row_number() OVER (PARTITION BY source ORDER BY turn) - 1 AS nth FROM u JOIN c ON u >= lo AND u < hi),
x AS (SELECT turn, source, turn * 16 + slot AS place, (nth * 16 + slot) // size AS cycle, (nth * 16 + slot) % size AS pos FROM d JOIN sz USING (source), range(16) AS k(slot)),
n AS (SELECT doc_id, source, cycle, row_number() OVER (PARTITION BY source, cycle ORDER BY md5(CAST(CAST(('0x' || substr(sha256('42|' || source || '|' || CAST(cycle AS STRING)), 9, 8))::UBIGINT & 2147483647 AS BIGINT) AS STRING) || '|' || CAST(doc_id AS STRING)), doc_id) - 1 AS pos
    FROM r JOIN (SELECT DISTINCT source, cycle FROM x) USING (source))"""


@query(f"WITH {_SCAN} SELECT doc_id, source, turn, place, CAST(cycle AS BIGINT) AS cycle FROM x JOIN n USING (source, cycle, pos)")
def weighted_scan(spark, sf_dir):
    """Eighty turns of a filtered weighted scan, stopped and resumed by its state after thirty."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    w = d.select("source").distinct().withColumn("weight", F.when(F.col("source") == "src1", 3.0).when(F.col("source") == "src2", 0.0).otherwise(1.0))
    first, state = corpus.weighted_scan(d, w, 30, 16, key="doc_id", keep=F.col("n_chars") >= 300)
    rest, _ = corpus.weighted_scan(d, w, 50, 16, json.loads(json.dumps(state)), key="doc_id", keep=F.col("n_chars") >= 300)
    return first.unionByName(rest).select("doc_id", "source", "turn", "place", "cycle")


@query("""SELECT uid, '{"year":' || year || ',"kind":"' || kind || '","items":' || count(*) || ',"weight":' || sum(weight) || '}' AS result FROM probe_scores GROUP BY uid, year, kind""", ("probe_scores",))
def result_json(spark, sf_dir):
    """A round's results as one JSON object a row."""
    g = view(spark, sf_dir, "probe_scores").groupBy("uid", "year", "kind").agg(F.count("*").alias("items"), F.sum("weight").alias("weight"))
    return sinks.as_result(g, "uid")


@query("""WITH p AS (SELECT CAST(event_id % 5 AS INTEGER) AS round, count(*) AS n FROM events GROUP BY 1), w AS (SELECT DISTINCT user_id % 20 AS week FROM events)
SELECT 'prompts' AS kind, round, NULL AS uid, n AS items, true AS found FROM p
UNION ALL SELECT 'completions', CAST(event_id % 5 AS INTEGER), user_id % 3, count(*) * CASE WHEN event_id % 5 = 2 THEN 2 ELSE 1 END, true FROM events GROUP BY event_id % 5, user_id % 3
UNION ALL SELECT 'week', CAST(k AS INTEGER), NULL, NULL, k IN (SELECT week FROM w) FROM range(15, 25) AS t(k)""")
def stored_payloads(spark, sf_dir):
    """Prompts and completions of rounds as JSON in keyed tables, those of one round replaced, and whether a week has run."""
    s = _store(spark)
    e = table(spark, sf_dir, "events").withColumns({"round": (F.col("event_id") % 5).cast("int"), "uid": F.col("user_id") % 3})
    s.upsert("quality_prompts", e.groupBy("round").agg(F.to_json(F.transform(F.sequence(F.lit(1), F.count("*").cast("int")), lambda i: F.struct(i.alias("prompt")))).alias("prompts_json")))
    c = e.groupBy("round", "uid").agg(F.count("*").cast("int").alias("n")).withColumn("year", F.lit(2020))
    texts = lambda n: F.to_json(F.transform(F.sequence(F.lit(1), n), lambda i: i.cast("string"))).alias("completions_json")
    s.upsert("quality_completions", c.select("round", "year", "uid", texts(F.col("n"))))
    s.upsert("quality_completions", c.where("round = 2").select("round", "year", "uid", texts(2 * F.col("n"))))
    s.insert_ignore("eval_runs", e.select((F.col("user_id") % 20).alias("week")).distinct())
    null = F.lit(None).cast("long")
    items = lambda j: F.json_array_length(j).cast("long").alias("items")
    weeks = spark.createDataFrame([("week", w, None, None, s.has("eval_runs", week=w)) for w in range(15, 25)], "kind string, round int, uid long, items long, found boolean")
    prompts = s.read("quality_prompts").select(F.lit("prompts").alias("kind"), "round", null.alias("uid"), items("prompts_json"), F.lit(True).alias("found"))
    return prompts.unionByName(s.read("quality_completions").select(F.lit("completions").alias("kind"), "round", "uid", items("completions_json"), F.lit(True).alias("found"))).unionByName(weeks)
