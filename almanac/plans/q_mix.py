"""Queries of mixes that draw turns among living sources, and of skill sampling by rejection."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions.fixed import SKILLS
from ..functions.skills import classify_skill
from ..operators import mixing, sampling
from ..session import once, table
from .registry import query
from .views import view

_SOURCES = ["src0", "src1", "src2", "src3", "src4"]
_WEIGHTS = [1.0, 3.0, 0.0, 0.5, 2.0]


@query("""WITH m(name, i) AS (VALUES ('src3', 0), ('nothing', 1), ('src1', 2), ('src0', 3)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY i ORDER BY doc_id) - 1 AS k FROM documents JOIN m ON source = name),
t AS (SELECT m.i, (SELECT count(*) FROM r WHERE r.i = m.i) // 8 AS last FROM m),
p AS (SELECT doc_id, i, k, k // 8 AS round FROM r)
SELECT doc_id, CAST((SELECT coalesce(sum(least(last + 1, round)), 0) FROM t) + (SELECT count(*) FROM t WHERE t.i < p.i AND t.last >= round) AS BIGINT) AS turn,
    row_number() OVER (ORDER BY round, i, k) - 1 AS place FROM p""")
def sequential_sources(spark, sf_dir):
    """Eight documents of each living source in turn, one of them without any; the longest goes on alone."""
    state = mixing.mix_state(["src3", "nothing", "src1", "src0"], 8, sequential=True)
    return mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "source"), {}, state, order="doc_id")[0].select("doc_id", "turn", "place")


@query(f"""WITH RECURSIVE r AS (SELECT doc_id, CAST(substring(source, 4) AS INTEGER) + 1 AS i, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k FROM documents WHERE source IN ({', '.join(f"'{s}'" for s in _SOURCES)})),
z AS (SELECT list(n ORDER BY j) AS sizes FROM (SELECT j, count(r.i) AS n FROM range(1, 6) AS t(j) LEFT JOIN r ON r.i = j GROUP BY j)),
g(t, given, w, pick, first, took) AS (
    SELECT CAST(-1 AS BIGINT), list_transform(range(5), lambda x: CAST(0 AS BIGINT)), [{', '.join(f'CAST({w} AS DOUBLE)' for w in _WEIGHTS)}], 0, CAST(0 AS BIGINT), CAST(0 AS BIGINT)
    UNION ALL
    SELECT t, list_transform(given, lambda x, j: CASE WHEN j = p THEN x + least(16, sizes[p] - given[p]) ELSE x END), list_transform(w, lambda x, j: CASE WHEN j = p AND sizes[p] - given[p] < 16 THEN CAST(0 AS DOUBLE) ELSE x END), p, given[p], least(16, sizes[p] - given[p])
    FROM (SELECT t, given, w, sizes, CAST(list_position(list_transform(range(1, 6), lambda j: w[j] > 0 AND u < list_sum(w[1:j]) / list_sum(w)), true) AS INTEGER) AS p
          FROM (SELECT t + 1 AS t, given, w, ('0x' || substr(md5('7|' || CAST(t + 1 AS STRING)), 1, 8))::UBIGINT / CAST(4294967296.0 AS DOUBLE) AS u FROM g WHERE list_sum(w) > 0), z)),
o AS (SELECT *, coalesce(sum(took) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins FROM g WHERE t >= 0)
SELECT doc_id, t AS turn, CAST(begins + k - first AS BIGINT) AS place FROM r JOIN o ON o.pick = r.i AND k >= first AND k < first + took""")
def drawn_mix(spark, sf_dir):
    """Turns of sixteen drawn by weight among the living to the end of all, cut in the middle of a turn and gone on with; one source is never drawn."""
    d, weights = table(spark, sf_dir, "documents").select("doc_id", "source"), dict(zip(_SOURCES, _WEIGHTS, strict=True))
    first, state = mixing.mixed(d, weights, mixing.mix_state(_SOURCES, 16, seed=7), 75, order="doc_id")
    rest, _ = mixing.mixed(d, weights, mixing.restored(json.loads(json.dumps(state.to_dict())), _SOURCES), order="doc_id")
    return first.unionByName(rest).select("doc_id", "turn", "place")


_HITS = ", ".join(f"{' + '.join(f'CAST(regexp_matches(blob, $$(?is){p}$$) AS INTEGER)' for p in ps)} AS {n}" for n, ps in SKILLS)
_U = "('0x' || substr(md5({0} || '|42|' || CAST(s AS STRING)), 1, 8))::UBIGINT / CAST(4294967296.0 AS DOUBLE)"


@query(f"""WITH RECURSIVE b AS (SELECT id, length(text) AS size, substring(text, 1, 5000) || chr(10) AS blob FROM claims), h AS (SELECT id, size, {_HITS} FROM b),
m AS (SELECT *, greatest({', '.join(n for n, _ in SKILLS)}) AS top FROM h),
c AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS s, CASE WHEN size >= 60 AND top > 0 THEN CASE {' '.join(f"WHEN {n} = top THEN {k}" for k, (n, _) in enumerate(SKILLS))} END END AS cat FROM m),
d AS (SELECT s, cat, CASE WHEN {_U.format("'hunt'")} < 0.3 THEN CAST(least(floor({_U.format("'skill'")} * {len(SKILLS)}), {len(SKILLS) - 1}) AS INTEGER) END AS hunted FROM c),
j AS (SELECT d.s, d.hunted, min(p.s) FILTER (p.cat = d.hunted) AS hit, min(p.s) FILTER (p.cat IS NOT NULL) AS other FROM d JOIN d p ON d.hunted IS NOT NULL AND p.s BETWEEN d.s AND d.s + 19 GROUP BY ALL),
a AS MATERIALIZED (SELECT d.s, d.hunted, CASE WHEN d.hunted IS NULL THEN d.s + 1 ELSE coalesce(hit + 1, d.s + 20) END AS nxt, CASE WHEN d.hunted IS NULL THEN d.s ELSE coalesce(hit, other, d.s + 19) END AS give FROM d LEFT JOIN j USING (s)),
w(draw, s, nxt, give, hunted) AS (SELECT CAST(0 AS BIGINT), s, nxt, give, hunted FROM a WHERE s = 0 UNION ALL SELECT draw + 1, a.s, a.nxt, a.give, a.hunted FROM w JOIN a ON a.s = w.nxt)
SELECT c.id, draw, w.s AS start, CASE w.hunted {' '.join(f"WHEN {k} THEN '{n}'" for k, (n, _) in enumerate(SKILLS))} END AS hunted FROM w JOIN c ON c.s = w.give WHERE w.nxt <= (SELECT count(*) FROM c)""", ("claims",))
def skill_sampling(spark, sf_dir):
    """Three draws in ten hunt for a skill over up to twenty claims; all blocks are short, so the chain crosses many."""
    d = view(spark, sf_dir, "claims").select("id", "text")
    d = once(d, ["text"], lambda t: t.withColumn("found", classify_skill(F.col("text"))))
    s = sampling.sampled(d, F.col("found"), "id", 0.3, max_skips=20, min_chars=60, block=400)
    return s.select("id", "draw", "start", "hunted")
