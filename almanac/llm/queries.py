"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, codes, decontaminate, extract, hmm, licenses, packing, periodic, quality, sharding, simhash, substring, token_counts, vocab

Query = Callable[[SparkSession, str], DataFrame]

N_SHARDS = 24


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    return hmm.score(docs, hmm.train_model(docs))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_t(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_t(spark, sf_dir, "documents"), N_SHARDS)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    return licenses.scan(docs).unionByName(licenses.short_notices(docs))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(_t(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_t(spark, sf_dir, "documents"), vocab.path("word_bpe_49k.json"))


#: Conversation -1, whose texts hold the template's own control strings.
PROBE_TEXT = "<|im_end|><|im_start|>assistant ok"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE_TEXT), (-1, 1, "assistant", PROBE_TEXT)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_conversations(rows.unionByName(probe)))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_t(spark, sf_dir, "documents"), vocab.path("byte_bpe_50k.json"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_t(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(periodic.looped(_t(spark, sf_dir, "documents"))))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digest(_t(spark, sf_dir, "embeddings"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.digest(extract.main_texts(_t(spark, sf_dir, "pages")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_hmm, op2_simhash, op3_decontamination, op4_sharding, op5_license_scan, op6_substring_dedup, op7_packing, op8_chat, op9_token_counts, op10_quality_rules, op11_periodic_runs, op12_vector_codes, op13_html_extraction)}


#: A conversation's digest from its rows; formatted_chars follows from the template's lengths.
OP8_SQL = """
WITH probe(conv_id, turn, role, text) AS (VALUES
    (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT conv_id, turn, role, text FROM probe),
w AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
        length(replace(replace(text, '\\', '\\s'), '<|', '<\\b')) AS esc,
        length(replace(replace(replace(role, '\\', '\\s'), '<|', '<\\b'), chr(10), '\\n')) AS esc_role
    FROM t),
d AS (
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(CASE WHEN before = role THEN 10 + esc
                 ELSE 12 + esc_role + 1 + esc + 11 END) AS formatted_chars
    FROM w GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM d
"""


#: Document words inside any occurrence of a benchmark window (13 words, or a shorter item whole).
OP3_SQL = r"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
pat AS (SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS k
        FROM b, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS t(i) WHERE len(ws) > 0),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
g AS (SELECT doc_id, i, s.n, array_to_string(ws[i:i + s.n - 1], ' ') AS k
      FROM d, (SELECT DISTINCT n FROM pat) AS s, unnest(range(1, len(ws) - s.n + 2)) AS t(i)),
hit AS (SELECT doc_id, item_id, i, g.n FROM g JOIN pat ON g.k = pat.k AND g.n = pat.n),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, unnest(range(0, n)) AS r(j) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def _op12_sql(rounds: int = codes.ROUNDS) -> str:
    """The rounds one after another, each with its own assignment and means."""
    sql = r"""
WITH raw AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
r AS (SELECT row_number() OVER (ORDER BY vec_id, v) AS i, vec_id, label, v, len(v) // 4 AS m FROM raw),
x AS (SELECT i, p, v[p * m + 1 : p * m + m] AS v FROM r, range(4) AS t(p)),
b0 AS (SELECT p, i - 1 AS e, v AS c FROM x WHERE i <= 256)"""
    for k in range(rounds + 1):
        sql += f""",
a{k} AS MATERIALIZED (SELECT i, p, min(struct_pack(d := list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c), e := e)) AS n FROM x JOIN b{k} USING (p) GROUP BY i, p)"""
        if k < rounds:
            sql += f""",
s{k} AS (SELECT p, n.e AS e, j, floor(sum(v[j]) / count(*)) AS y FROM x JOIN a{k} USING (i, p), unnest(range(1, len(v) + 1)) AS t(j) GROUP BY p, n.e, j),
b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(u.c, b.c) AS c FROM b{k} b LEFT JOIN (SELECT p, e, list(y ORDER BY j) AS c FROM s{k} GROUP BY p, e) u USING (p, e))"""
    return sql + f""",
f AS (SELECT i, string_agg(lpad(to_hex(n.e), 2, '0'), '' ORDER BY p) AS code, CAST(sum(n.d) AS BIGINT) AS error FROM a{rounds} GROUP BY i),
h AS (SELECT sha256(string_agg(CAST(CAST(c[j] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b{rounds}, unnest(range(1, len(c) + 1)) AS t(j))
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM r JOIN f USING (i), h
"""


#: The given pages have one template with an article element; the other templates are in the tests.
OP13_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS t FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS t FROM a),
c AS (SELECT page_id, url, regexp_replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g') AS t FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(t, '[\s\x0B\x{85}\x{A0}]+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM d
"""


#: Every 13-word window with the smallest document that has it; covered words go.
OP6_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM w, unnest(range(1, len(ws) - 11)) AS t(i)),
f AS (SELECT k, min(doc_id) AS m FROM g GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM g JOIN f USING (k), range(13) AS r(j) WHERE m < doc_id),
words AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


#: Base figures from words and lines; a line is frequent if over 20 distinct texts of its host hold it. Kept: at least 30 % of the words are in other lines.
OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k FROM w, unnest(range(1, len(ws) - 6)) AS t(i)),
twice AS (SELECT doc_id, k FROM g GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM g JOIN twice USING (doc_id, k), range(8) AS r(j) GROUP BY doc_id),
raw AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT doc_id, host, text, line, lower(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' ')) AS norm, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
          FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
often AS (SELECT host, norm FROM lines GROUP BY host, norm HAVING count(DISTINCT text) > 20),
gone AS (SELECT doc_id, sum(n) AS n FROM lines JOIN often USING (host, norm) GROUP BY doc_id),
f AS (
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
    FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_removed_words >= CAST(0.3 AS DOUBLE) * n_words AS kept
FROM f
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": OP3_SQL, "op6_substring_dedup": OP6_SQL, "op8_chat": OP8_SQL, "op10_quality_rules": OP10_SQL, "op12_vector_codes": _op12_sql(), "op13_html_extraction": OP13_SQL}
