"""Queries of limits, counters, names and whole corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, names
from ..functions.fixed import DEFAULTS
from ..operators import corpus, rank
from ..session import table
from . import build
from .registry import query
from .views import view


@query("SELECT p_partkey, p_retailprice > 1500 OR p_size > 40 AS too_large FROM part WHERE p_size IN (1, 5, 9, 41, 45, 50)")
def size_limits(spark, sf_dir):
    """Limits that fail beyond (not at) their value, over an allow-list of rows."""
    allowed = corpus.within(table(spark, sf_dir, "part"), "p_size", [1, 5, 9, 41, 45, 50])
    return allowed.select("p_partkey", corpus.over_limits({"p_retailprice": 1500, "p_size": 40}).alias("too_large"))


@query("""SELECT s_suppkey, coalesce(a.v, b.v) AS found FROM supplier LEFT JOIN (SELECT c_custkey AS k, 'first ' || c_name AS v FROM customer WHERE c_custkey % 2 = 0) a ON a.k = s_suppkey
LEFT JOIN (SELECT c_custkey AS k, 'second ' || c_name AS v FROM customer WHERE c_custkey % 3 = 0) b ON b.k = s_suppkey""")
def fallback_lookup(spark, sf_dir):
    """The preferred file of a submission, else the other one."""
    c = table(spark, sf_dir, "customer")
    side = lambda m, label: c.where(F.col("c_custkey") % m == 0).select(F.col("c_custkey").alias("s_suppkey"), F.concat(F.lit(label), F.col("c_name")).alias("found"))
    return corpus.first_found(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey", "found", side(2, "first "), side(3, "second "))


@query("SELECT count(*) AS scanned, count(*) FILTER (length(text) >= 500) AS kept, count(*) FILTER (length(text) < 500) AS skipped, count(*) FILTER (text IS NULL) AS bad FROM documents")
def scan_counters(spark, sf_dir):
    n = F.length("text")
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("scanned"), F.count_if(n >= 500).alias("kept"), F.count_if(n < 500).alias("skipped"), F.count_if(n.isNull()).alias("bad"))


@query("SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS parameters, CAST(sum(p_size * CASE WHEN p_name LIKE '%ring%' THEN 2 ELSE 4 END) AS BIGINT) AS bytes FROM part GROUP BY 1")
def parameter_totals(spark, sf_dir):
    """Parameters and stored bytes, names of one kind in half precision."""
    named = F.when(F.contains("p_name", F.lit("ring")), "model.embed_tokens.weight").otherwise("model.layer.weight")
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.sum("p_size").alias("parameters"), F.sum(names.stored_bytes(named, F.col("p_size"))).alias("bytes"))


@query("""SELECT page_id, regexp_matches(u, '^[/.~]|^[A-Za-z]:|\\\\') OR length(u) - length(replace(u, '/', '')) > 1 AS is_path FROM
(SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'owner/name' WHEN 1 THEN './' || url WHEN 2 THEN url ELSE 'model' END AS u FROM pages)""")
def local_paths(spark, sf_dir):
    u = F.expr("CASE page_id % 4 WHEN 0 THEN 'owner/name' WHEN 1 THEN './' || url WHEN 2 THEN url ELSE 'model' END")
    return table(spark, sf_dir, "pages").select("page_id", names.is_local_path(u).alias("is_path"))


@query("""SELECT event_id, ('0x' || substr(md5('swap|' || CAST(user_id AS STRING) || '|' || CAST(event_id AS STRING)), 1, 8))::UBIGINT < 2147483648 AS swap,
CAST(2014 + floor(('0x' || substr(md5('year|' || CAST(user_id AS STRING)), 1, 8))::UBIGINT / 4294967296.0 * 11) AS INTEGER) AS year FROM events""")
def draws(spark, sf_dir):
    """Position swaps with odds of one half, and a second evaluation year, both drawn by hashes of their keys."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", dates.drawn_swap(F.col("user_id"), F.col("event_id")).alias("swap"), dates.drawn_year(2014, 11, F.col("user_id")).alias("year"))


@query("SELECT event_id, user_id AS step, event_type AS best FROM events")
def settings_lines(spark, sf_dir):
    """``key=value`` lines as a map."""
    m = names.settings(F.format_string("step=%d\nbest=%s", F.col("user_id"), F.col("event_type")))
    return table(spark, sf_dir, "events").select("event_id", m["step"].cast("long").alias("step"), m["best"].alias("best"))


@query("""WITH v AS (SELECT *, CASE WHEN swap AND raw = 'a' THEN 'b' WHEN swap AND raw = 'b' THEN 'a' ELSE raw END AS x FROM verdicts),
t AS (SELECT uid_a, uid_b, count(*) FILTER (x = 'a') AS wins_a, count(*) FILTER (x = 'b') AS wins_b, count(*) FILTER (x = 'tie') AS ties, count(*) AS n FROM v GROUP BY ALL)
SELECT *, CASE WHEN wins_a > wins_b THEN uid_a WHEN wins_b > wins_a THEN uid_b END AS winner FROM t""", ("verdicts",))
def two_model_duels(spark, sf_dir):
    return build.two_model_duel(view(spark, sf_dir, "verdicts"))


@query("""WITH g AS (SELECT uid, year, kind, CAST(sum(CASE WHEN score > -11.51 THEN weight ELSE 0 END) AS DOUBLE) / sum(weight) AS ratio FROM probe_scores GROUP BY ALL),
w AS (SELECT uid, year, coalesce(bool_or(ratio > 0.7) FILTER (kind = 'known'), false) AND NOT coalesce(bool_or(ratio > 0.1) FILTER (kind = 'unknown'), false) AS ok FROM g GROUP BY ALL)
SELECT uid, bool_and(ok) AS passed, count(*) AS years FROM w GROUP BY uid""", ("probe_scores",))
def self_test(spark, sf_dir):
    return build.self_test(view(spark, sf_dir, "probe_scores"), DEFAULTS)


_MIX = """a AS (SELECT 'dated' AS source, id, text, CASE WHEN year <= 1998 THEN year END AS year, 2.0 AS w FROM (SELECT *, CAST(CASE WHEN regexp_matches(timestamp, '^[0-9]{4}(-|$)') THEN substring(timestamp, 1, 4) END AS INTEGER) AS y FROM claims)
    WHERE y <= 1998 AND length(text) >= 60),
b AS (SELECT 'snapshot' AS source, doc_id AS id, text, NULL AS year, 1.0 AS w FROM documents WHERE length(text) >= 1000),
n AS (SELECT source, id, (row_number() OVER (PARTITION BY source ORDER BY id) - 0.5) / w AS place FROM (SELECT source, id, w FROM a UNION ALL SELECT source, id, w FROM b))"""


@query(f"WITH {_MIX} SELECT source, id, round(place, 6) AS place FROM n", ("claims",))
def mixed_corpus(spark, sf_dir):
    """Two sources under a cutoff, a dated one at twice the weight of a snapshot."""
    specs = [
        {"name": "dated", "table": view(spark, sf_dir, "claims"), "id_field": "id", "date_field": "timestamp", "min_chars": 60, "weight": 2.0},
        {"name": "snapshot", "table": table(spark, sf_dir, "documents"), "snapshot_year": 1998, "min_chars": 1000},
    ]
    return build.build_corpus(spark, specs, 1998).select("source", "id", F.round("place", 6).alias("place"))


@query("SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS r FROM documents WHERE length(text) >= 1) WHERE r > 100")
def start_offset(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where(F.length("text") >= 1).select("doc_id", "text")
    return build.skip(rows, ["doc_id"], 100)


@query("SELECT conv_id, CAST(count(*) FILTER (role = 'assistant' AND text <> '') AS BIGINT) > 0 AS active FROM conversations GROUP BY conv_id")
def active_players(spark, sf_dir):
    """Players with at least one completion that isn't empty."""
    return rank.active(table(spark, sf_dir, "conversations"), "conv_id", (F.col("role") == "assistant") & (F.col("text") != ""))


@query("""WITH y AS (SELECT unnest(range(2013, 2025)) AS year), u AS (SELECT DISTINCT uid FROM submissions), s AS (SELECT uid, year, max(value) AS v FROM submissions GROUP BY ALL)
SELECT u.uid, CAST(y.year AS INTEGER) AS year, coalesce(v, 0) AS score FROM u CROSS JOIN y LEFT JOIN s ON s.uid = u.uid AND s.year = y.year""", ("submissions",))
def required_year_grid(spark, sf_dir):
    """Every submitter in every required year; what is missing scores 0 (an explode of the fixed years, no cross join)."""
    s = view(spark, sf_dir, "submissions")
    best = s.groupBy("uid", "year").agg(F.max("value").alias("v"))
    grid = s.select("uid").distinct().withColumn("year", F.explode(names.required_years()))
    return grid.join(best, ["uid", "year"], "left").select("uid", "year", F.coalesce("v", F.lit(0.0)).alias("score"))
