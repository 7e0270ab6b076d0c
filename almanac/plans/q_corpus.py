"""Queries of scans, filters, weights, mixing, shuffling and packing."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, names
from ..functions.fixed import SKILLS
from ..operators import bpe, corpus
from ..session import once, spread, table
from ..sources import text_files
from .registry import query
from .views import view

CUTOFF = 2018


@query("SELECT doc_id, source, lang, length(text) AS n FROM documents WHERE length(text) >= 200 AND lang IN ('en', 'de')")
def partition_scan(spark, sf_dir):
    rows = text_files.scan(table(spark, sf_dir, "documents"), min_chars=200, partitions=("lang", ["en", "de"]))
    return rows.select("doc_id", "source", "lang", F.length("text").cast("long").alias("n"))


@query("SELECT doc_id, substring(text, 1, 80) AS head FROM documents WHERE length(text) > 0 ORDER BY doc_id LIMIT 50")
def inspect_texts(spark, sf_dir):
    """The first texts in key order, truncated: a top-k by definition."""
    return text_files.scan(table(spark, sf_dir, "documents")).orderBy("doc_id").limit(50).select("doc_id", F.substring("text", 1, 80).alias("head"))


_YEAR = """CASE WHEN regexp_matches(trim(raw_date), '^([0-9]{4}$|[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8})') THEN CAST(substring(trim(raw_date), 1, 4) AS INTEGER) END"""


@query(f"""SELECT id, {_YEAR} AS year_of_text,
CAST(CASE WHEN x > 1e9 THEN year(make_timestamp(CAST(x * 1000000 AS BIGINT))) WHEN floor(x) BETWEEN 1900 AND 2100 THEN floor(x) END AS INTEGER) AS year_of_number
FROM (SELECT *, CASE WHEN raw_number > 1e12 THEN raw_number / 1000 ELSE raw_number END AS x FROM dated_rows)""", ("dated_rows",))
def mixed_date_years(spark, sf_dir):
    return view(spark, sf_dir, "dated_rows").select("id", dates.year_of_text(F.col("raw_date")).alias("year_of_text"), dates.year_of_number(F.col("raw_number")).alias("year_of_number"))


@query("""WITH t AS (SELECT id, trim(raw_date) AS t, CASE WHEN raw_number > 1e12 THEN raw_number / 1000 ELSE raw_number END AS x FROM dated_rows),
k AS (SELECT *, coalesce(regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2}'), false) AS m, coalesce(regexp_matches(t, '^[0-9]{8}$'), false) AS e, CASE WHEN x > 1e9 THEN make_timestamp(CAST(x * 1000000 AS BIGINT)) END AS tm FROM t)
SELECT id, CASE WHEN m OR e THEN CAST(substring(t, 1, 4) AS INTEGER) END AS y, CASE WHEN m THEN CAST(substring(t, 6, 2) AS INTEGER) WHEN e THEN CAST(substring(t, 5, 2) AS INTEGER) END AS mo,
    CASE WHEN m THEN CAST(substring(t, 9, 2) AS INTEGER) WHEN e THEN CAST(substring(t, 7, 2) AS INTEGER) END AS d, CAST(year(tm) AS INTEGER) AS ny, CAST(month(tm) AS INTEGER) AS nmo, CAST(day(tm) AS INTEGER) AS nd FROM k""", ("dated_rows",))
def date_parts(spark, sf_dir):
    """Year, month and day of texts (a date in front, or any ISO date) and of numbers (epoch seconds or milliseconds)."""
    p, n = dates.ymd_of_text(F.col("raw_date")), dates.ymd_of_number(F.col("raw_number"))
    return view(spark, sf_dir, "dated_rows").select("id", p["year"].alias("y"), p["month"].alias("mo"), p["day"].alias("d"), n["year"].alias("ny"), n["month"].alias("nmo"), n["day"].alias("nd"))


@query(f"""SELECT id, CASE WHEN int_score IS NULL THEN true WHEN int_score < 3 THEN false WHEN score IS NULL THEN true ELSE score >= 2 END AS quality,
CASE WHEN y IS NULL THEN true ELSE y BETWEEN 2016 AND 2019 END AS dated, coalesce(y BETWEEN 2016 AND 2019, false) AS required FROM (SELECT *, {_YEAR} AS y FROM dated_rows)""", ("dated_rows",))
def row_filters(spark, sf_dir):
    """Quality floor and date window, with and without a required date."""
    year = dates.year_of_text(F.col("raw_date"))
    return view(spark, sf_dir, "dated_rows").select(
        "id", corpus.passes_quality(F.col("int_score"), F.col("score"), 3, 2.0).alias("quality"), corpus.passes_date(year, 2016, 2019).alias("dated"), corpus.passes_date(year, 2016, 2019, True).alias("required"))


@query(f"""SELECT id, true AS snapshot_alone, coalesce(y <= 2018, true) AS snapshot_dated, coalesce(y <= 2018, false) AS dated_alone, coalesce(y <= 2018 AND y >= 2016, false) AS with_minimum, coalesce(y <= 2018, false) AS required
FROM (SELECT *, {_YEAR} AS y FROM dated_rows)""", ("dated_rows",))
def source_keep_rule(spark, sf_dir):
    """The keep rule's truth table: snapshot and date field, minimum year, required date."""
    y = dates.year_of_text(F.col("raw_date"))
    rule = lambda *a, **k: corpus.keeps_source_row(y, CUTOFF, *a, **k)
    return view(spark, sf_dir, "dated_rows").select(
        "id", rule(True, False).alias("snapshot_alone"), rule(True, True).alias("snapshot_dated"), rule(False, True).alias("dated_alone"), rule(True, True, min_year=2016).alias("with_minimum"), rule(True, True, require_date=True).alias("required"))


@query("""WITH k AS (SELECT id, trim(raw_date) AS t, CASE WHEN raw_number > 1e12 THEN raw_number / 1000 ELSE raw_number END AS x FROM dated_rows),
d AS (SELECT id, 'text' AS kind, substring(t, 1, 4) AS y, CAST(CASE WHEN regexp_matches(t, '^[0-9]{8}$') THEN substring(t, 5, 2) ELSE substring(t, 6, 2) END AS INTEGER) AS mo FROM k WHERE regexp_matches(t, '^(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|^[0-9]{8}$')
    UNION ALL SELECT id, 'number', CAST(year(tm) AS VARCHAR), CAST(month(tm) AS INTEGER) FROM (SELECT id, make_timestamp(CAST(x * 1000000 AS BIGINT)) AS tm FROM k WHERE x > 1e9))
SELECT id, kind, mo FROM d WHERE y = '2018' AND mo BETWEEN 1 AND 9""", ("dated_rows",))
def month_window(spark, sf_dir):
    """Some months of a year, by dates of text and of number."""
    v = view(spark, sf_dir, "dated_rows")
    of = lambda kind, c, ymd: text_files.month_range(v, 2018, 1, 9, c).select("id", F.lit(kind).alias("kind"), ymd(F.col(c))["month"].alias("mo"))
    return of("text", "raw_date", dates.ymd_of_text).unionByName(of("number", "raw_number", dates.ymd_of_number))


@query("""SELECT doc_id, CAST(regexp_extract(dump, '^CC-MAIN-([0-9]{4})-[0-9]+$', 1) AS INTEGER) AS crawl_year, CAST(substring(snapshot, 1, 4) AS INTEGER) AS snapshot_year,
CAST(substring(dump, 9, 4) AS INTEGER) <= 2018 AS in_time FROM crawl_docs""", ("crawl_docs",))
def crawl_years(spark, sf_dir):
    c = view(spark, sf_dir, "crawl_docs")
    return c.select("doc_id", dates.crawl_year(F.col("dump")).alias("crawl_year"), dates.snapshot_year(F.col("snapshot")).alias("snapshot_year"), (dates.crawl_year(F.col("dump")) <= CUTOFF).alias("in_time"))


@query("""WITH d AS (SELECT DISTINCT dump, CAST(substring(dump, 9, 4) AS INTEGER) AS year FROM crawl_docs), c AS (SELECT year, count(*) AS n FROM d GROUP BY year),
w AS (SELECT year, n, CASE WHEN year = 2015 THEN 0 ELSE year - 2015.0 END AS w FROM c)
SELECT dump, round(w / (SELECT sum(w) FROM w) / n, 6) AS weight FROM d JOIN w USING (year)""", ("crawl_docs",))
def source_weights(spark, sf_dir):
    """Year mass over crawls; 2015 has no weight."""
    d = view(spark, sf_dir, "crawl_docs").select("dump").distinct()
    years = d.select(dates.crawl_year(F.col("dump")).alias("year")).distinct().withColumn("weight", F.greatest(F.lit(0.0), F.col("year") - 2015.0))
    return corpus.source_weights(d, years).withColumn("weight", F.round("weight", 6))


@query("SELECT year, count(*) AS n FROM (SELECT DISTINCT dump, CAST(substring(dump, 9, 4) AS INTEGER) AS year FROM crawl_docs) GROUP BY year", ("crawl_docs",))
def crawls_per_year(spark, sf_dir):
    return view(spark, sf_dir, "crawl_docs").select("dump").distinct().groupBy(dates.crawl_year(F.col("dump")).alias("year")).agg(F.count("*").alias("n"))


@query("""WITH w AS (SELECT source, CAST(row_number() OVER (ORDER BY source) AS DOUBLE) AS weight FROM (SELECT DISTINCT source FROM crawl_docs)),
c AS (SELECT source, sum(weight) OVER (ORDER BY source) / sum(weight) OVER () AS hi, (sum(weight) OVER (ORDER BY source) - weight) / sum(weight) OVER () AS lo FROM w),
u AS (SELECT doc_id, ('0x' || substr(md5('42|' || CAST(doc_id // 16 AS STRING)), 1, 8))::UBIGINT / 4294967296.0 AS u FROM crawl_docs)
SELECT doc_id, c.source AS picked FROM u JOIN c ON u >= lo AND u < hi""", ("crawl_docs",))
def weighted_picks(spark, sf_dir):
    """Sixteen neighbouring documents share a weighted draw of a source."""
    rows = view(spark, sf_dir, "crawl_docs")
    w = rows.select("source").distinct().select("source", F.row_number().over(Window.orderBy("source")).cast("double").alias("weight"))
    return corpus.pick_source(rows.select("doc_id"), w, F.col("doc_id"), "source", 16).select("doc_id", "picked")


@query("""WITH n AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM crawl_docs)
SELECT doc_id, source, pos, pos // 8 AS turn, round((pos + 0.5) / (CASE WHEN source = 'src1' THEN 3 ELSE 1 END), 6) AS place FROM n WHERE source <> 'src2'""", ("crawl_docs",))
def source_mix(spark, sf_dir):
    """Weighted interleaving with turns: src1 counts three times, src2 not at all."""
    rows = view(spark, sf_dir, "crawl_docs").select("doc_id", "source")
    w = rows.select("source").distinct().withColumn("weight", F.when(F.col("source") == "src1", 3.0).when(F.col("source") == "src2", 0.0).otherwise(1.0))
    mixed = corpus.mix(corpus.turns(rows, "source", "doc_id", 8), w, "source", "doc_id")
    return mixed.select("doc_id", "source", F.col("pos").cast("long").alias("pos"), "turn", F.round("place", 6).alias("place"))


@query("SELECT doc_id, epoch, md5('7|' || CAST(epoch AS STRING) || '|' || CAST(doc_id AS STRING)) AS shuffle_key FROM documents, range(2) AS r(epoch)")
def shuffled_epochs(spark, sf_dir):
    """Every epoch in its own seeded order (the key is the sort key)."""
    rows = corpus.epochs(table(spark, sf_dir, "documents").select("doc_id"), 2)
    return rows.select("doc_id", F.col("epoch").cast("long").alias("epoch"), F.md5(F.concat_ws("|", F.lit("7"), F.col("epoch").cast("string"), F.col("doc_id").cast("string")).cast("binary")).alias("shuffle_key")).orderBy("epoch", "shuffle_key")


@query("SELECT dump, cycle, CAST(('0x' || substr(sha256('42|' || dump || '|' || CAST(cycle AS STRING)), 9, 8))::UBIGINT & 2147483647 AS BIGINT) AS seed FROM (SELECT DISTINCT dump FROM crawl_docs), range(3) AS r(cycle)", ("crawl_docs",))
def stable_seeds(spark, sf_dir):
    d = view(spark, sf_dir, "crawl_docs").select("dump").distinct().withColumn("cycle", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))))
    return d.select("dump", "cycle", dates.stable_seed(F.lit(42), F.col("dump"), F.col("cycle")).alias("seed"))


# Every ninth document has no text; a document without tokens gives nothing, not even an end token.
_WORDS = "words AS (SELECT doc_id, regexp_extract_all(CASE WHEN doc_id % 9 = 4 THEN '' ELSE coalesce(text, '') END, '[^ \\n\\t]+') AS ws FROM documents)"


def _lengths(spark, sf_dir):
    """(doc_id, ids): word lengths as token ids."""
    text = F.when(F.col("doc_id") % 9 == 4, "").otherwise(F.coalesce("text", F.lit("")))
    words = F.regexp_extract_all(text, F.lit(r"[^ \n\t]+"), F.lit(0))
    return table(spark, sf_dir, "documents").select("doc_id", F.transform(words, F.length).alias("ids"))


@query(f"""WITH {_WORDS}, d AS (SELECT doc_id, CASE WHEN len(ws) > 0 THEN len(ws) + 1 ELSE 0 END AS n FROM words), o AS (SELECT *, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM d)
SELECT doc_id, CAST(n AS BIGINT) AS n_tokens, CAST(off AS BIGINT) AS "offset", CAST(off // 1024 AS BIGINT) AS block_id FROM o""")
def token_offsets(spark, sf_dir):
    """Running token offsets and the block each document begins in."""
    n = F.when(F.size("ids") > 0, F.size("ids") + 1).otherwise(0).cast("long")
    o = corpus.token_offsets(_lengths(spark, sf_dir), n, "doc_id")
    return o.select("doc_id", "n_tokens", "offset", F.floor(F.col("offset") / 1024).cast("long").alias("block_id"))


@query(f"""WITH {_WORDS}, b AS (SELECT doc_id, list_append(list_transform(ws, lambda w: length(w)), 0) AS ids FROM words WHERE len(ws) > 0),
t AS (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM b), n AS (SELECT id, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos FROM t)
SELECT pos // 1024 AS block_id, CAST(sum(id * (pos % 1024 + 1)) AS BIGINT) AS digest FROM n GROUP BY block_id HAVING count(*) = 1024""")
def packed_blocks(spark, sf_dir):
    """Word lengths as tokens, an end token per document that has any, blocks of 1024; a position-weighted sum stands for each block."""
    blocks = corpus.pack_blocks(_lengths(spark, sf_dir), 1024)
    return blocks.select("block_id", F.aggregate(F.transform("input_ids", lambda x, i: x.cast("long") * (i + 1)), F.lit(0).cast("long"), lambda a, x: a + x).alias("digest"))


@query("""WITH a AS (SELECT DISTINCT dump FROM crawl_docs WHERE doc_id % 2 = 0), b AS (SELECT DISTINCT dump FROM crawl_docs WHERE doc_id % 3 = 0 AND doc_id % 5 <> 1)
SELECT dump, 'both' AS side FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT dump, 'first only' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""", ("crawl_docs",))
def crawl_sets(spark, sf_dir):
    """Intersection and difference of two sets of crawls (tokenizer and training; training and validation)."""
    c = view(spark, sf_dir, "crawl_docs")
    a, b = c.where("doc_id % 2 = 0").select("dump"), c.where("doc_id % 3 = 0 AND doc_id % 5 <> 1").select("dump")
    return a.intersect(b).withColumn("side", F.lit("both")).unionByName(a.distinct().join(b.distinct(), "dump", "left_anti").withColumn("side", F.lit("first only")))


@query("SELECT dump, min(doc_id) AS first, row_number() OVER (ORDER BY min(doc_id)) AS pos FROM crawl_docs GROUP BY dump", ("crawl_docs",))
def ordered_distinct(spark, sf_dir):
    """Distinct names in order of first occurrence; there are few names, so one window numbers them."""
    d = view(spark, sf_dir, "crawl_docs").groupBy("dump").agg(F.min("doc_id").alias("first"))
    return d.select("dump", "first", F.row_number().over(Window.orderBy("first")).cast("long").alias("pos"))


@query("SELECT doc_id AS id, text, NULL AS extra, 'documents' AS origin FROM documents UNION ALL SELECT item_id, text, 'bench', 'benchmark' FROM benchmark")
def union_sources(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", F.lit("documents").alias("origin"))
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text", F.lit("bench").alias("extra"), F.lit("benchmark").alias("origin"))
    return d.unionByName(b, allowMissingColumns=True)


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 3 = 0 THEN 'literal ' || event_type WHEN event_id % 3 = 1 THEN 'nested ' || event_type ELSE 'none' END AS nested FROM events""")
def nested_fields(spark, sf_dir):
    """Field access by dotted path over JSON rows; a key with a dot in its name comes before the path."""
    e = table(spark, sf_dir, "events")
    inner = F.when(F.col("event_id") % 3 < 2, F.to_json(F.struct(F.concat(F.lit("nested "), F.col("event_type")).alias("k"))))
    row = F.concat(F.lit("{"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('"meta.k": "literal '), F.col("event_type"), F.lit('", '))).otherwise(""), F.lit('"meta": '), F.coalesce(inner, F.lit("{}")), F.lit("}"))
    return e.select("event_id", names.dotted(F.col("props"), "k").cast("long").alias("k"), F.coalesce(names.dotted(row, "meta.k"), F.lit("none")).alias("nested"))


_HITS = ", ".join(f"{' + '.join(f'CAST(regexp_matches(blob, $$(?is){p}$$) AS INTEGER)' for p in ps)} AS {n}" for n, ps in SKILLS)


@query(f"""WITH b AS (SELECT id, text, substring(text, 1, 5000) || chr(10) AS blob FROM claims), h AS (SELECT id, text, {_HITS} FROM b), m AS (SELECT *, greatest({', '.join(n for n, _ in SKILLS)}) AS top FROM h),
t AS (SELECT id, CASE WHEN length(text) >= 40 THEN CASE {' '.join(f"WHEN top > 0 AND {n} = top THEN '{n}'" for n, _ in SKILLS)} END END AS skill FROM m),
c AS (SELECT skill, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS n_all FROM t GROUP BY skill), r AS (SELECT skill, CASE WHEN skill IS NULL THEN 0 ELSE n_all * 0.25 * (CAST(1 AS DOUBLE) / {len(SKILLS)}) / n END AS rate FROM c)
SELECT id, t.skill, CAST(1 + floor(rate) + CASE WHEN ('0x' || substr(md5('42|' || CAST(id AS STRING)), 1, 8))::UBIGINT / 4294967296.0 < rate - floor(rate) THEN 1 ELSE 0 END AS INTEGER) AS copies FROM t JOIN r ON t.skill IS NOT DISTINCT FROM r.skill""", ("claims",))
def skill_upsampling(spark, sf_dir):
    """Every document once, and documents of a skill again so that skilled draws get their share."""
    from ..functions.skills import classify_skill

    d = view(spark, sf_dir, "claims").select("id", "text")
    d = once(d, ["text"], lambda t: t.withColumn("found", classify_skill(F.col("text"))))
    return corpus.skill_mix(d, F.col("found"), F.col("id"), 0.2, min_chars=40).select("id", "skill", "copies")


@query()
def bpe_encode(spark, sf_dir):
    """Merges from distributed pair counts of a bounded sample, then every document encoded."""
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    merges = bpe.train(bpe.word_counts(d, "doc_id"), 1000)
    return bpe.encode(d.select("doc_id", "text"), merges).select("doc_id", F.size("ids").alias("n_tokens"), F.octet_length("text").alias("n_bytes"))
