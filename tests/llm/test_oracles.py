"""The subpackage's SQL against its queries at the smallest scale, and its contract queries' columns."""

import os

import duckdb
import pytest
from almanac.llm import queries


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, sf, duck, name):
    df = queries.queries()[name](spark, sf)
    cols = sorted(df.columns)
    r = duck.sql(queries.oracle_sql()[name])
    assert sorted(r.columns) == cols
    assert sorted(tuple(x[c] for c in cols) for x in df.collect()) == sorted(tuple(x[r.columns.index(c)] for c in cols) for x in r.fetchall())


def test_contract_columns(spark, sf):
    want = {
        "op1_hmm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        "op2_simhash": "doc_id bigint, fingerprint string, component_id bigint",
        "op3_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
        "op4_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
        "op6_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
        "op7_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
        "op8_chat": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        "op9_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
        "op10_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
        "op11_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
        "op12_vector_codes": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
        "op13_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    }
    q = queries.queries()
    for name, columns in want.items():
        got = dict(q[name](spark, sf).dtypes)
        for c in columns.split(", "):
            k, t = c.split(" ")
            assert got[k] == t, (name, k)
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in q}
