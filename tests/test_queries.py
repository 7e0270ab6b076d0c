"""Every registered query of the library runs at the smallest scale; those with SQL equal DuckDB's rows."""

import datetime

import duckdb
import pytest
from almanac.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, float):
        return repr(x + 0.0)
    return [plain(y) for y in x] if isinstance(x, (list, tuple)) else repr(x)


@pytest.fixture(scope="session")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in cols] for r in df.collect()), key=str)
    assert got
    if name in catalog.ORACLES:
        r = duck.sql(catalog.ORACLES[name])
        assert sorted(r.columns) == cols
        assert got == sorted(([plain(x[r.columns.index(c)]) for c in cols] for x in r.fetchall()), key=str)


def test_entry_and_registry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 15
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and set(catalog.QUERIES) <= set(q)


def test_both_sides_of_predicates_occur(spark, sf):
    for name, column in (("leak_gates", "exceeded"), ("dated_claim", "dated"), ("exact_duplicates", "duplicate"), ("weight_cosine", "duplicate"), ("spectral_distance", "duplicate"), ("output_divergence", "duplicate"), ("greedy_dedup", "accepted"), ("repo_validation", "valid"), ("cache_lookup", "hit"), ("crawl_years", "in_time"), ("stable_spans", "stable"), ("time_budget", "skipped"), ("running_best", "improved")):
        values = {r[0] for r in catalog.QUERIES[name](spark, sf).select(column).distinct().collect()}
        assert values >= {True, False}, name


def test_no_python_where_expressions_do(spark, sf):
    for name, f in catalog.QUERIES.items():
        if name in ("singular_values", "tall_spectra", "bpe_encode", "stream_daily_cap", "greedy_dedup", "skill_sampling"):
            continue
        plan = f(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan, name
