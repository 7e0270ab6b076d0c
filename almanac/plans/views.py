"""Input views for the queries, built from the tables by SQL that Spark and DuckDB both read.

Each view is a SELECT over table names in braces, so ``{orders}`` is a DataFrame in Spark and
the table ``orders`` in DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions.fixed import MONTHS
from ..session import spread

_month = "CASE month({0}) " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MONTHS, 1)) + " END"
_yr = "CAST(year(o_orderdate) AS STRING)"

VIEWS: dict[str, str] = {}

VIEWS["probe_scores"] = """
SELECT user_id AS uid, CAST(2020 + CAST(floor(event_id / 2) AS BIGINT) % 3 AS INT) AS year,
    CASE WHEN event_id % 2 = 0 THEN 'known' ELSE 'unknown' END AS kind, CAST(CASE WHEN event_id % 5 = 0 THEN 5 ELSE 1 END AS INT) AS weight,
    CASE WHEN event_id % 2 = 0 THEN -value / 6 ELSE -value END AS score, event_id
FROM {events}"""

_PEOPLE = ["Anna Weber", "Luis Prado", "Maria Stone", "Ivan Petrov", "Grace Hill", "Omar Haddad", "Keir Doyle"]
_PLACES = ["Lyon", "Porto", "New Delhi", "Oslo", "Quito"]
_pick = lambda names, key: "CASE " + key + " " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"

VIEWS["claims"] = f"""
SELECT id, year, title, text, timestamp, url FROM (
SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INT) AS year,
    CASE o_orderkey % 4 WHEN 0 THEN p1 || ' wins the ' || place || ' final' WHEN 1 THEN 'short' WHEN 2 THEN NULL ELSE 'Markets in ' || place || ' closed higher' END AS title,
    CASE o_orderkey % 13
        WHEN 0 THEN 'In ' || y || ', ' || p1 || ' won the ' || place || ' open against ' || p2 || '.'
        WHEN 1 THEN 'In ' || m || ' ' || y || ' ' || p1 || ' met ' || p2 || ' near ' || place || '. The talks were long and quiet.'
        WHEN 2 THEN p1 || ' was elected president of the Harbour Council in ' || y || ', after ' || p2 || ' resigned in ' || place || '.'
        WHEN 3 THEN 'The council of ' || place || ' announced the plan in ' || CAST(year(o_orderdate) - 1 AS STRING) || ' with ' || p2 || '.'
        WHEN 4 THEN p1 || ' launched a new line in ' || place || '. Nothing else was said about it today.'
        WHEN 5 THEN 'Subscribe to our newsletter' || chr(10) || p1 || ' visited ' || place || ' in late ' || m || ' ' || y || ' and signed the accord.' || chr(10) || 'Read more: here'
        WHEN 6 THEN 'Too short in ' || y || '.'
        WHEN 7 THEN upper(place) || ' (AP) - ' || p1 || ' defeated ' || p2 || ' (' || y || ') by a wide margin, ' || y || '.'
        WHEN 8 THEN 'home' || chr(10) || chr(10) || chr(10) || chr(10) || '  The River Bank opened   in ' || m || ' ' || y || ' at ' || place || '.  ' || chr(10) || 'ok'
        WHEN 9 THEN 'In ' || CAST(year(o_orderdate) + 1 AS STRING) || ', the final will be hosted by ' || p2 || ' in ' || place || '.'
        WHEN 10 THEN 'Rain fell on ' || place || ' for days and nobody minded it at all! The fields were green. "So it goes," said ' || p1 || '. Then came ' || y || ' at last.'
        WHEN 11 THEN 'The games of ' || y || ' were hosted by ' || p2 || ' in ' || place || '. ' || p1 || ' won gold. Click here to read more about all of it' || chr(10) || 'In ' || y || ', ' || p1 || ' died.'
        ELSE 'in ' || y || ', the merger of two firms was approved by the Trade Commission after a year of talks; ' || p1 || ' signed it.' END AS text,
    CASE o_orderkey % 3 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) WHEN 1 THEN y ELSE NULL END AS timestamp,
    CASE WHEN o_orderkey % 9 = 0 THEN 'http://example.org/wikipedia/' ELSE NULL END AS url
FROM (SELECT o_orderkey, o_orderdate, {_yr} AS y, {_month.format('o_orderdate')} AS m,
        {_pick(_PEOPLE, 'o_custkey % 7')} AS p1, {_pick(_PEOPLE, '(o_custkey + 3) % 7')} AS p2, {_pick(_PLACES, 'c_nationkey % 5')} AS place
      FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey))"""

VIEWS["dated_rows"] = """
SELECT d.doc_id AS id, CAST(l.quality * 4 - l.toxic AS INT) AS int_score, CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE (d.doc_id % 100) / 20.0 END AS score, d.n_chars,
    CASE d.doc_id % 9
        WHEN 0 THEN CAST(2015 + d.doc_id % 8 AS STRING)
        WHEN 1 THEN CAST(2015 + d.doc_id % 8 AS STRING) || '-0' || CAST(1 + d.doc_id % 7 AS STRING) || '-15T10:00:00Z'
        WHEN 2 THEN CAST(2015 + d.doc_id % 8 AS STRING) || '0131'
        WHEN 3 THEN ' ' || CAST(2015 + d.doc_id % 8 AS STRING) || '-11-05 '
        WHEN 4 THEN 'May ' || CAST(2015 + d.doc_id % 8 AS STRING)
        WHEN 5 THEN NULL
        WHEN 6 THEN ''
        WHEN 7 THEN '1850-01-01'
        ELSE CAST(2015 + d.doc_id % 8 AS STRING) || '13' END AS raw_date,
    CASE d.doc_id % 5 WHEN 0 THEN 1420070400.0 + d.doc_id * 864000.0 WHEN 1 THEN (1420070400.0 + d.doc_id * 864000.0) * 1000 WHEN 2 THEN 2010.0 + d.doc_id % 9 WHEN 3 THEN 12.0 ELSE NULL END AS raw_number
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id"""

VIEWS["crawl_docs"] = """
SELECT doc_id, n_chars, 'CC-MAIN-' || CAST(2015 + doc_id % 5 AS STRING) || '-' || CAST(10 + doc_id % 7 AS STRING) AS dump,
    CAST(2015 + doc_id % 6 AS STRING) || '0101.' || lang AS snapshot, source, text
FROM {documents}"""

VIEWS["submissions"] = """
SELECT event_id, user_id AS uid, CAST(2013 + event_id % 12 AS INT) AS year,
    CASE WHEN event_id % 7 = 0 THEN 'user' || CAST(user_id AS STRING) || '/model@main' ELSE 'user' || CAST(user_id AS STRING) || '/model@' || substring(md5(CAST(event_id % 40 AS STRING)) || md5('x'), 1, 40) END AS repo,
    md5(CAST(event_id % 97 AS STRING)) AS content, ts, CASE WHEN user_id % 10 = 3 THEN NULL ELSE CAST(ts AS STRING) END AS snapshot_at, value
FROM {events}"""

VIEWS["verdicts"] = """
SELECT CAST(2020 + a.event_id % 2 AS INT) AS year, a.user_id % 8 AS uid_a, 8 + a.user_id % 5 AS uid_b, a.event_id AS prompt_idx,
    CASE WHEN a.value < 20 THEN 'a' WHEN a.value < 45 THEN 'b' ELSE 'tie' END AS raw, a.event_id % 3 = 0 AS swap, a.event_type AS category
FROM {events} a"""

VIEWS["leak_scores"] = """
SELECT user_id AS uid, round(-sum(value) / count(*) / 9, 6) AS score, min(event_id) AS pos FROM {events} GROUP BY user_id"""


def names(view: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", VIEWS[view])


def duck(view: str) -> str:
    """The view as a DuckDB common table expression."""
    return f"{view} AS ({VIEWS[view].format(**{n: n for n in names(view)})})"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names(name)}
    if name == "claims":  # its texts go through long expressions
        tables["orders"] = spread(tables["orders"], "o_orderkey")
    return spark.sql(VIEWS[name], **tables)
