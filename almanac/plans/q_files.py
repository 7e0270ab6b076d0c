"""Queries of file readers: tables are written into the shared folder in a source's format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import file_system, shared_folder, table
from ..sources import text_files
from .registry import query


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


@query(f"SELECT t AS text, count(*) AS n FROM (SELECT {_STRIP.format('text')} AS t FROM documents) WHERE length(t) >= 30 GROUP BY t")
def split_json_files(spark, sf_dir):
    """Documents as JSON lines, the text under another key in some and a number in its place, read in byte ranges."""
    d, folder = table(spark, sf_dir, "documents"), _folder(spark, "jsonl")
    of = lambda m, c: F.when(F.col("doc_id") % 3 == m, c)
    d.select(of(0, F.col("text")).alias("text"), of(1, F.col("text")).alias("body"), of(2, F.col("doc_id")).alias("content"), of(2, F.col("text")).alias("document")).write.json(folder)
    return text_files.split_documents(spark, folder, 30).groupBy("text").agg(F.count("*").alias("n"))


@query(rf"""WITH p AS (SELECT {_STRIP.format('c')} AS t FROM (SELECT unnest(regexp_split_to_array(text, '\n\s*\n+')) AS c FROM documents))
SELECT t AS text, count(*) AS n FROM p WHERE length(t) >= 60 GROUP BY t""")
def split_text_files(spark, sf_dir):
    """Documents one behind another in text files, with an empty line between, read as paragraphs in byte ranges."""
    folder = _folder(spark, "txt")
    table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.concat("text", F.lit("\n"))).write.text(folder)
    return text_files.split_documents(spark, folder, 60).groupBy("text").agg(F.count("*").alias("n"))


@query("SELECT event_id, user_id, value FROM events WHERE event_id % 7 BETWEEN 2 AND 4")
def parquet_shards(spark, sf_dir):
    """Seven shards by name, of which the third to the fifth are read."""
    e, folder = table(spark, sf_dir, "events"), _folder(spark, "shards")
    e.withColumn("k", F.col("event_id") % 7).write.partitionBy("k").parquet(f"{folder}/all")
    fs, _ = file_system(spark, folder)
    at = lambda name: file_system(spark, f"{folder}/{name}")[1]
    fs.mkdirs(at("named"))
    for k in range(7):
        for n, file in enumerate(sorted(s.getPath().toString() for s in fs.listStatus(at(f"all/k={k}")) if s.getPath().getName().endswith(".parquet"))):
            fs.rename(file_system(spark, file)[1], at(f"named/shard-{k}-{n:03d}.parquet"))
    names = sorted(s.getPath().getName() for s in fs.listStatus(at("named")))
    first, behind = (next(i for i, n in enumerate([*names, "shard-9"]) if n >= f"shard-{k}") for k in (2, 5))
    return text_files.shards(spark, f"{folder}/named", "shard-", first, behind).select("event_id", "user_id", "value")


_FACTS = "SELECT DISTINCT 'Type ' || p_type AS prompt, p_brand AS phrase, CAST(2000 + p_size % 3 AS INTEGER) AS year FROM part WHERE p_size % 5 = 0"


def _facts(spark, sf_dir):
    p = table(spark, sf_dir, "part").where("p_size % 5 = 0")
    return p.select(F.concat(F.lit("Type "), F.col("p_type")).alias("prompt"), F.col("p_brand").alias("phrase"), (2000 + F.col("p_size") % 3).cast("int").alias("year")).distinct()


def _as_list(rows, path):
    """One JSON list in one file, as such files are: types, brands and years are few, whatever the table's size."""
    rows.agg(F.to_json(F.coalesce(F.collect_list(F.struct("*")), F.array())).alias("value")).coalesce(1).write.text(path)


@query(_FACTS)
def facts_file(spark, sf_dir):
    folder = _folder(spark, "facts")
    _as_list(_facts(spark, sf_dir), folder)
    return text_files.facts(spark, folder)


@query(f"SELECT prompt, CASE WHEN year = 2000 THEN 'unknown' ELSE phrase END AS category, count(*) AS n FROM ({_FACTS}) GROUP BY ALL")
def prompt_banks(spark, sf_dir):
    """Prompts in a list, some with a category, some as plain strings."""
    folder = _folder(spark, "bank")
    plain = F.expr("substring(to_json(array(prompt)), 2, length(to_json(array(prompt))) - 2)")
    item = F.when(F.col("year") == 2000, plain).otherwise(F.to_json(F.struct(F.col("prompt"), F.col("phrase").alias("category"))))
    _facts(spark, sf_dir).agg(F.concat(F.lit('{"prompts": ['), F.array_join(F.collect_list(item), ","), F.lit("]}")).alias("value")).coalesce(1).write.text(folder)
    return text_files.prompt_bank(spark, folder).groupBy("prompt", "category").agg(F.count("*").alias("n"))


@query(f"""WITH f AS ({_FACTS}), y(k) AS (VALUES (2000), (2001))
SELECT CAST(k AS INTEGER) AS year, CASE WHEN year <= k THEN 'known' ELSE 'unknown' END AS kind, prompt, phrase, year AS fact_year, CAST(CASE WHEN year = k THEN 5 ELSE 1 END AS INTEGER) AS weight FROM f, y""")
def benchmark_files(spark, sf_dir):
    """Known and unknown items of two years in their files."""
    folder, facts = _folder(spark, "benchmarks"), _facts(spark, sf_dir)
    fs, _ = file_system(spark, folder)
    for k in (2000, 2001):
        for known in (True, False):
            side = facts.where(F.col("year") <= k if known else F.col("year") > k)
            items = side.select("prompt", "phrase", "year", F.when(F.col("year") == k, 5).otherwise(1).alias("weight"))
            path = text_files.benchmark_path(folder, k, known)
            items.agg(F.to_json(F.struct(F.collect_list(F.struct("*")).alias("items"))).alias("value")).coalesce(1).write.text(f"{path}.parts")
            part = next(s.getPath() for s in fs.listStatus(file_system(spark, f"{path}.parts")[1]) if s.getPath().getName().startswith("part-"))
            fs.rename(part, file_system(spark, path)[1])
    return text_files.benchmark_folder(spark, folder, [2000, 2001]).select("year", "kind", "prompt", "phrase", "fact_year", "weight")
