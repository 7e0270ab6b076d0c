"""Queries of leak scoring, tournaments, rewards and the result cache."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import names
from ..functions.core import strip
from ..functions.fixed import DEFAULTS, PUBLISHED
from ..operators import rank, selection
from ..operators.order import numbered
from ..session import table
from .registry import query
from .views import view

YEARS = [2020, 2021, 2022]

_GATES = """
g AS (SELECT uid, year, kind, list_sort(list(score))[CAST(floor(count(*) / 2) AS INTEGER) + 1] AS median,
        CAST(sum(CASE WHEN score > -11.51 THEN weight ELSE 0 END) AS DOUBLE) / sum(weight) AS ratio FROM probe_scores GROUP BY ALL),
w AS (SELECT uid, year, coalesce(max(median) FILTER (WHERE kind = 'known'), -20) AS km, coalesce(max(median) FILTER (WHERE kind = 'unknown'), -20) AS um,
        coalesce(bool_or(ratio > 0.7) FILTER (WHERE kind = 'known'), false) AS known_ok, NOT coalesce(bool_or(ratio > 0.1) FILTER (WHERE kind = 'unknown'), false) AS unknown_ok
      FROM g GROUP BY uid, year)"""


@query(f"WITH {_GATES.strip()} SELECT uid, year, kind, round(median, 6) AS median, round(ratio, 6) AS ratio, ratio > CASE kind WHEN 'known' THEN 0.7 ELSE 0.1 END AS exceeded FROM g", ("probe_scores",))
def leak_gates(spark, sf_dir):
    g = rank.gates(view(spark, sf_dir, "probe_scores"), ["uid", "year"])
    return g.select("uid", "year", "kind", F.round("median", 6).alias("median"), F.round("ratio", 6).alias("ratio"), "exceeded")


@query(f"WITH {_GATES.strip()} SELECT uid, year, round(CASE WHEN known_ok AND unknown_ok THEN um - km ELSE 0 END, 6) AS score, known_ok, unknown_ok FROM w", ("probe_scores",))
def leak_year_scores(spark, sf_dir):
    y = rank.year_scores(view(spark, sf_dir, "probe_scores"))
    return y.select("uid", "year", F.round("score", 6).alias("score"), "known_ok", "unknown_ok")


@query(f"""WITH {_GATES.strip()}, s AS (SELECT uid, sum(CASE WHEN known_ok AND unknown_ok THEN um - km ELSE 0 END) / 3 AS score FROM w GROUP BY uid)
SELECT uid, round(score, 6) AS score, score < -3 AS qualifies FROM s""", ("probe_scores",))
def leak_gate(spark, sf_dir):
    """The flagship: probes to gates to year scores to each submitter's mean over all required years."""
    s = rank.leak_scores(rank.year_scores(view(spark, sf_dir, "probe_scores")), YEARS)
    return s.select("uid", F.round("score", 6).alias("score"), (F.col("score") < DEFAULTS["min_eval_score"]).alias("qualifies"))


_Q = """q AS (SELECT uid, score, greatest(0, least(1, (-3 - score) / (-3 + 6))) AS normalised, row_number() OVER (ORDER BY score, pos, uid) AS rank FROM leak_scores WHERE score < -3 ORDER BY score, pos, uid LIMIT 10)"""


@query(f"WITH {_Q} SELECT uid, score, round(normalised, 6) AS normalised, CAST(rank AS INTEGER) AS rank FROM q", ("leak_scores",))
def qualification(spark, sf_dir):
    return rank.qualify(view(spark, sf_dir, "leak_scores")).withColumn("normalised", F.round("normalised", 6))


@query(f"WITH {_Q} SELECT a.uid AS uid_a, b.uid AS uid_b FROM q a JOIN q b ON a.rank < b.rank", ("leak_scores",))
def round_robin_pairs(spark, sf_dir):
    return rank.pairs(rank.qualify(view(spark, sf_dir, "leak_scores")), "rank")


_V = "v AS (SELECT *, CASE WHEN swap AND raw = 'a' THEN 'b' WHEN swap AND raw = 'b' THEN 'a' ELSE raw END AS verdict FROM verdicts)"
_T = "t AS (SELECT year, uid_a, uid_b, count(*) FILTER (verdict = 'a') AS wins_a, count(*) FILTER (verdict = 'b') AS wins_b, count(*) FILTER (verdict = 'tie') AS ties, count(*) AS n FROM v GROUP BY ALL)"


@query(f"WITH {_V}, {_T} SELECT * FROM t", ("verdicts",))
def duel_tally(spark, sf_dir):
    return rank.tally(view(spark, sf_dir, "verdicts"), ["year", "uid_a", "uid_b"])


@query(f"WITH {_V} SELECT coalesce(category, 'total') AS category, count(*) FILTER (verdict = 'a') AS wins_a, count(*) FILTER (verdict = 'b') AS wins_b, count(*) FILTER (verdict = 'tie') AS ties, count(*) AS n FROM v GROUP BY ROLLUP (category)", ("verdicts",))
def duel_by_category(spark, sf_dir):
    """Stats per category of the prompts, with a total row."""
    v = view(spark, sf_dir, "verdicts")
    return rank.tally_by_category(rank.with_category(v.drop("category"), v.select("prompt_idx", "category")))


_R = "r AS (SELECT year, uid, sum(w) AS wins, sum(n) AS prompts FROM (SELECT year, uid_a AS uid, wins_a AS w, n FROM t UNION ALL SELECT year, uid_b, wins_b, n FROM t) GROUP BY ALL)"


@query(f"WITH {_V}, {_T}, {_R} SELECT year, uid, CAST(wins AS BIGINT) AS wins, CAST(prompts AS BIGINT) AS prompts, round(wins / greatest(1, prompts), 6) AS win_rate FROM r", ("verdicts",))
def tournament_win_rates(spark, sf_dir):
    return rank.win_rates(rank.tally(view(spark, sf_dir, "verdicts"), ["year", "uid_a", "uid_b"]), ("year",)).withColumn("win_rate", F.round("win_rate", 6))


@query(f"WITH {_V}, {_T}, {_R} SELECT uid, round(sum(wins / greatest(1, prompts)) / 2, 6) AS win_rate FROM r GROUP BY uid", ("verdicts",))
def tournament_mean(spark, sf_dir):
    rates = rank.win_rates(rank.tally(view(spark, sf_dir, "verdicts"), ["year", "uid_a", "uid_b"]), ("year",))
    return rank.mean_over_years(rates, 2).withColumn("win_rate", F.round("win_rate", 6))


_F = f"{_V}, {_T}, {_R}, m AS (SELECT uid, sum(wins / greatest(1, prompts)) / 2 AS win_rate FROM r GROUP BY uid), f AS (SELECT q.*, coalesce(win_rate, 0) AS win_rate, CASE WHEN count(*) OVER () = 1 THEN 1 ELSE 0.7 * normalised + 0.3 * coalesce(win_rate, 0) END AS final FROM q LEFT JOIN m USING (uid))"


def _finals(spark, sf_dir):
    rates = rank.mean_over_years(rank.win_rates(rank.tally(view(spark, sf_dir, "verdicts"), ["year", "uid_a", "uid_b"]), ("year",)), 2)
    return rank.final_scores(rank.qualify(view(spark, sf_dir, "leak_scores")), rates)


@query(f"WITH {_Q}, {_F} SELECT uid, round(final, 6) AS final, round(win_rate, 6) AS win_rate, round(normalised, 6) AS normalised FROM f", ("leak_scores", "verdicts"))
def final_scores(spark, sf_dir):
    return _finals(spark, sf_dir).select("uid", F.round("final", 6).alias("final"), F.round("win_rate", 6).alias("win_rate"), F.round("normalised", 6).alias("normalised"))


@query(f"""WITH {_Q}, {_F}, p AS (SELECT uid, row_number() OVER (ORDER BY final DESC, rank) AS place FROM f WHERE final > 0 AND uid <> 0),
c AS (SELECT uid, place, exp(-0.8 * pow(place - 1, 0.9)) AS e FROM p WHERE place <= 10)
SELECT uid, CAST(place AS INTEGER) AS place, round(e / sum(e) OVER () * 0.3, 6) AS weight FROM c UNION ALL SELECT 0, NULL, 0.7 FROM (SELECT count(*) AS n FROM c) WHERE n > 0""", ("leak_scores", "verdicts"))
def reward_weights(spark, sf_dir):
    return rank.rewards(_finals(spark, sf_dir), {**DEFAULTS, "emission_pct": 0.3}).withColumn("weight", F.round("weight", 6))


@query("SELECT uid, place, weight FROM (SELECT uid, CAST(row_number() OVER (ORDER BY score, uid) AS INTEGER) AS place, round(CASE WHEN score < -5 THEN 0 ELSE -score / 10 END, 6) AS weight FROM leak_scores) WHERE weight > 0", ("leak_scores",))
def current_weights(spark, sf_dir):
    s = view(spark, sf_dir, "leak_scores")
    w = rank.places(s, ["score", "uid"]).select("uid", "place", F.round(F.when(F.col("score") < -5, 0.0).otherwise(-F.col("score") / 10), 6).alias("weight"))
    return rank.current_weights(w, 0).join(w.select("uid", "place"), "uid").select("uid", "place", "weight")


# Scores by hand with what three configurations must give: none (best -6), the published one (best -11.51) and swapped bounds.
_HAND = [(-100.0, 1, 1, 0), (-12.0, 1, 1, 0), (-11.51, 1, 1, 0), (-8.0, 1, 0.587544, 0), (-7.0, 1, 0.470035, 0), (-6.0, 1, 0.352526, 0), (-4.5, 0.5, 0.176263, 0.5), (-3.0, 0, 0, 1), (0.0, 0, 0, 1), (1.0, 0, 0, 1)]


@query(f"""WITH hand(score, d, p, s) AS (VALUES {', '.join(f"({a}, {d}, {p}, {s})" for a, d, p, s in _HAND)})
SELECT uid, CAST(score AS DOUBLE) AS score, round(CASE WHEN score <= -6 THEN 1 WHEN score >= -3 THEN 0 ELSE (-3 - score) / 3 END, 6) AS normalised,
round(CASE WHEN score <= -11.51 THEN 1 WHEN score >= -3 THEN 0 ELSE (-3 - score) / CAST(8.51 AS DOUBLE) END, 6) AS published, round(CASE WHEN score <= -6 THEN 0 WHEN score >= -3 THEN 1 ELSE (score + 6) / 3 END, 6) AS swapped FROM leak_scores
UNION ALL SELECT NULL, CAST(score AS DOUBLE), CAST(d AS DOUBLE), CAST(p AS DOUBLE), CAST(s AS DOUBLE) FROM hand""", ("leak_scores",))
def score_normalisation(spark, sf_dir):
    """Scores between the threshold and the best score, which the configured epsilon is; rows by hand with the boundaries."""
    hand = spark.createDataFrame([(None, a) for a, *_ in _HAND], "uid long, score double")
    rows = view(spark, sf_dir, "leak_scores").select("uid", "score").unionByName(hand)
    by = lambda c: F.round(rank.normalised(F.col("score"), c), 6)
    return rows.select("uid", "score", by(DEFAULTS).alias("normalised"), by(PUBLISHED).alias("published"), by({**DEFAULTS, "min_eval_score": -6.0, "leak_epsilon": -3.0}).alias("swapped"))


@query("""WITH f AS (SELECT p_partkey AS id, p_name AS prompt, p_type AS phrase, CAST(2000 + p_size % 25 AS INTEGER) AS year FROM part)
SELECT id, prompt, phrase, year, 'known' AS kind, CASE WHEN year = 2012 THEN 5 ELSE 1 END AS weight FROM f WHERE year <= 2012
UNION ALL SELECT id, prompt, phrase, year, 'unknown', 1 FROM f WHERE year > 2012""")
def known_unknown_split(spark, sf_dir):
    f = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("prompt"), F.col("p_type").alias("phrase"), (2000 + F.col("p_size") % 25).cast("int").alias("year"))
    side = lambda known, kind: rank.build_benchmark(f, 2012, known).withColumn("kind", F.lit(kind))
    return side(True, "known").unionByName(side(False, "unknown"))


@query("""SELECT event_type AS layer, list_sort(list(value))[CAST(floor(count(*) / 2) AS INTEGER) + 1] AS upper_median, list_sort(list(value))[CAST(floor((count(*) - 1) / 2) AS INTEGER) + 1] AS lower_median,
round(exp(least(sum(value * user_id) / sum(user_id), 20)), 3) AS perplexity FROM events GROUP BY 1""")
def three_medians(spark, sf_dir):
    """Upper and lower medians, and the perplexity of a weighted mean loss (capped at exp 20)."""
    e = table(spark, sf_dir, "events")
    m = selection.medians(e, ["event_type"], "value").select(F.col("event_type").alias("_t"), F.col("upper").alias("upper_median"), F.col("lower").alias("lower_median"))
    p = e.groupBy(F.col("event_type").alias("layer")).agg(F.round(rank.perplexity("value", "user_id"), 3).alias("perplexity"))
    return p.join(m, F.col("layer").eqNullSafe(F.col("_t"))).drop("_t")


@query("""WITH x AS (SELECT l_returnflag AS flag, nullif(l_linenumber, 7) AS line, CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 2 = 0 THEN -l_extendedprice ELSE l_extendedprice * l_discount END AS x FROM lineitem)
SELECT flag, line, list_sort(list(x))[CAST(floor((count(x) - 1) / 2) AS INTEGER) + 1] AS lower, list_sort(list(x))[CAST(floor(count(x) / 2) AS INTEGER) + 1] AS upper FROM x WHERE x IS NOT NULL GROUP BY ALL""")
def exact_medians(spark, sf_dir):
    """Both medians by radix selection, whatever the groups' sizes; prices of both signs, zeros and NULLs, a NULL key."""
    price = F.when(F.col("l_orderkey") % 11 == 0, None).when(F.col("l_orderkey") % 2 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice") * F.col("l_discount"))
    x = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), F.nullif("l_linenumber", F.lit(7)).alias("line"), price.alias("x"))
    return selection.medians(x, ["flag", "line"], "x", buffered=0)


@query("SELECT event_id, uid, row_number() OVER (ORDER BY coalesce(snapshot_at, '9999'), event_id) AS place FROM submissions", ("submissions",))
def submission_order(spark, sf_dir):
    """Oldest first, a missing time last, then the given position."""
    s = view(spark, sf_dir, "submissions").select("event_id", "uid", F.coalesce("snapshot_at", F.lit("9999")).alias("t"))
    return numbered(s, ["t", "event_id"]).select("event_id", "uid", (F.col("pos") + 1).alias("place"))


@query("""SELECT event_id, regexp_extract(repo, '^(.*)@', 1) AS name, regexp_extract(repo, '@([^@]*)$', 1) AS revision, regexp_matches(repo, '^[^/@\\s]+/[^/@\\s]+@[0-9a-f]{40}$') AS valid FROM submissions""", ("submissions",))
def repo_validation(spark, sf_dir):
    return view(spark, sf_dir, "submissions").select("event_id", names.repo_parts(F.col("repo"))["name"].alias("name"), names.repo_parts(F.col("repo"))["revision"].alias("revision"), names.is_commit(F.col("repo")).alias("valid"))


@query("""WITH s AS (SELECT uid, list(DISTINCT year) AS ys FROM submissions GROUP BY uid)
SELECT uid, array_to_string(list_sort(list_filter(range(2013, 2025), lambda y: NOT list_contains(ys, y))), ',') AS missing FROM s""", ("submissions",))
def missing_years(spark, sf_dir):
    years = view(spark, sf_dir, "submissions").groupBy("uid").agg(F.collect_set("year").alias("ys"))
    return years.select("uid", F.array_join(names.missing_years(F.col("ys")), ",").alias("missing"))


@query("SELECT repo, array_to_string(list_sort(list(DISTINCT year)), ',') AS years, count(*) AS n FROM submissions GROUP BY repo", ("submissions",))
def years_of_repo(spark, sf_dir):
    s = view(spark, sf_dir, "submissions").groupBy("repo", "year").agg(F.count("*").alias("c"))
    return s.groupBy("repo").agg(F.array_join(F.transform(F.array_sort(F.collect_list("year")), lambda y: y.cast("string")), ",").alias("years"), F.sum("c").alias("n"))


# the result cache: evaluations keyed by (uid, year, round), as two batches of events
_NEW = "SELECT user_id AS uid, CAST(2020 + event_id % 3 AS INT) AS year, CAST(7 AS INT) AS round, event_type AS repo, value AS score, event_id AS evaluated_at, false AS synced FROM events"


def _evaluations(spark, sf_dir, late):
    e = table(spark, sf_dir, "events").where((F.col("event_id") % 4 == 0) if late else (F.col("event_id") % 4 != 0))
    return e.select(F.col("user_id").alias("uid"), (2020 + F.col("event_id") % 3).cast("int").alias("year"), F.lit(7).alias("round"), F.col("event_type").alias("repo"), F.col("value").alias("score"), F.col("event_id").alias("evaluated_at"), F.lit(False).alias("synced"))


_UP = f"n AS ({_NEW}), up AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY uid, year, round ORDER BY evaluated_at DESC) AS rn FROM n) WHERE rn = 1)"


def _cache(spark, sf_dir):
    return rank.upsert(_evaluations(spark, sf_dir, False), _evaluations(spark, sf_dir, True), ["uid", "year", "round"], "evaluated_at")


@query(f"WITH {_UP} SELECT * FROM up")
def cache_upsert(spark, sf_dir):
    return _cache(spark, sf_dir)


@query(f"WITH {_UP} SELECT e.event_id, up.uid IS NOT NULL AS hit, up.score FROM events e LEFT JOIN up ON e.user_id = up.uid AND 2020 + e.event_id % 3 = up.year AND e.event_type = up.repo")
def cache_lookup(spark, sf_dir):
    """Point lookups by key and repository: hits carry the score, the rest is the work list."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("uid"), (2020 + F.col("event_id") % 3).cast("int").alias("year"), F.col("event_type").alias("repo"))
    c = _cache(spark, sf_dir).select("uid", "year", "repo", "score", F.lit(True).alias("hit"))
    return e.join(c, ["uid", "year", "repo"], "left").select("event_id", F.coalesce("hit", F.lit(False)).alias("hit"), "score")


@query(f"WITH {_UP}, w AS (SELECT DISTINCT uid, year, repo FROM n) SELECT * FROM w ANTI JOIN up USING (uid, year, repo)")
def cache_work_list(spark, sf_dir):
    both = _evaluations(spark, sf_dir, False).unionByName(_evaluations(spark, sf_dir, True)).select("uid", "year", "repo").distinct()
    return both.join(_cache(spark, sf_dir).select("uid", "year", "repo"), ["uid", "year", "repo"], "left_anti")


@query(f"WITH {_UP} SELECT uid, year, evaluated_at % 2 = 0 AS synced FROM up")
def cache_mark_synced(spark, sf_dir):
    """Set synced for the acknowledged keys."""
    c = _cache(spark, sf_dir)
    acked = c.where("evaluated_at % 2 = 0").select("uid", "year", F.lit(True).alias("ack"))
    return c.join(acked, ["uid", "year"], "left").select("uid", "year", (F.col("synced") | F.coalesce("ack", F.lit(False))).alias("synced"))


@query(f"WITH {_UP} SELECT uid, year, repo, evaluated_at FROM up WHERE evaluated_at <= coalesce((SELECT max(evaluated_at) FROM up WHERE uid = 3), 9223372036854775807)")
def cache_cleanup(spark, sf_dir):
    return rank.delete_after_last(_cache(spark, sf_dir), 3).select("uid", "year", "repo", "evaluated_at")


@query("""WITH a AS (SELECT user_id AS week, min(event_id) AS first FROM events WHERE event_id % 3 = 0 GROUP BY 1), b AS (SELECT user_id AS week, min(event_id) AS first FROM events WHERE event_id % 3 = 1 GROUP BY 1)
SELECT * FROM a UNION ALL SELECT * FROM b ANTI JOIN a USING (week)""")
def cache_insert_ignore(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    weeks = lambda k: e.where(F.col("event_id") % 3 == k).groupBy(F.col("user_id").alias("week")).agg(F.min("event_id").alias("first"))
    return rank.insert_ignore(weeks(0), weeks(1), ["week"])


@query("SELECT event_id, user_id AS uid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, len(props) AS n FROM events")
def json_payloads(spark, sf_dir):
    """Prompts and completions are stored as JSON: parse, use a field, write back."""
    e = table(spark, sf_dir, "events")
    row = F.from_json("props", "k long")
    return e.select("event_id", F.col("user_id").alias("uid"), row["k"].alias("k"), F.length(F.replace(F.to_json(row), F.lit(":"), F.lit(": "))).alias("n"))


@query("""WITH s AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, substring(text, 1, 500) AS prompt, substring(next_text, 1, 300) AS completion FROM s WHERE role = 'user' AND next_role = 'assistant'""")
def judge_inputs(spark, sf_dir):
    """User turns with the assistant turn that follows, truncated as a judge sees them."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    s = table(spark, sf_dir, "conversations").withColumn("next_role", F.lead("role").over(w)).withColumn("next_text", F.lead("text").over(w))
    return s.where("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", names.truncated(F.col("text"), F.col("next_text"))["prompt"].alias("prompt"), names.truncated(F.col("text"), F.col("next_text"))["completion"].alias("completion"))


@query("SELECT coalesce(nullif(trim(p_type), ''), 'unknown') AS category, count(*) AS n FROM part GROUP BY 1")
def category_counts(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.coalesce(F.when(strip(F.col("p_type")) != "", F.trim("p_type")), F.lit("unknown")).alias("category")).agg(F.count("*").alias("n"))


@query("""SELECT s_nationkey AS repo, CAST(sum(s_suppkey % 1000) AS BIGINT) AS bytes, sha1(array_to_string(list_sort(list(s_name || ':' || CAST(s_suppkey % 1000 AS STRING) || ':' || CAST(s_nationkey AS STRING))), chr(10))) AS fingerprint,
max(CAST(regexp_extract(s_name, '^Supplier#([0-9]+)$', 1) AS INTEGER)) AS highest FROM supplier GROUP BY 1""")
def file_sets(spark, sf_dir):
    size, print_ = names.file_set(F.col("s_name"), F.col("s_suppkey") % 1000, F.col("s_nationkey"))
    return table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("repo")).agg(size.alias("bytes"), print_.alias("fingerprint"), F.max(names.number_after(F.col("s_name"), "Supplier#")).alias("highest"))


@query("""WITH used AS (SELECT DISTINCT CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS INTEGER) AS k, c_mktsegment AS prefix FROM customer),
r AS (SELECT prefix, unnest(range(0, max(k) + 2)) AS k FROM used GROUP BY prefix)
SELECT prefix, CAST(min(r.k) AS INTEGER) AS free FROM r ANTI JOIN used USING (prefix, k) GROUP BY prefix""")
def next_free_name(spark, sf_dir):
    """The first number that no name of a prefix uses: a gap between neighbours, or one past the end."""
    used = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("prefix"), names.number_after(F.col("c_name"), "Customer#").alias("k")).distinct()
    return names.first_free(used)
