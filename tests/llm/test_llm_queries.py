"""Queries with SQL against it, and what every query returns."""

import duckdb
import pytest
from helpers import SF01

from capset.llm.queries import ORACLES, QUERIES
from tools.oracle_check import TABLES, canon

COLUMNS = {
    "op1": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"], "op2": ["doc_id", "held_out", "score", "predicted"],
    "op3": ["page_id", "url", "text", "n_chars"], "op4": ["doc_id", "size", "source_size", "target", "taken"],
    "op5": ["doc_id", "n_shingles", "component_id", "kept"], "op6": ["page_id", "host", "path", "rule", "verdict"],
    "op7": ["doc_id", "held_out", "lang_pred", "score"], "op8": ["vec_id", "n_links", "component_id", "kept"],
    "op9": ["doc_id"], "op10": ["doc_id", "n_tokens"],
    "op11": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"], "op13": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op12": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    df = QUERIES[name](spark, SF01)
    cur = con.execute(ORACLES[name])
    want = canon([d[0] for d in cur.description], cur.fetchall())
    assert canon(df.columns, df.collect()) == want


def test_every_operator_has_its_query():
    assert {q.split("_")[0] for q in QUERIES} == set(COLUMNS)


@pytest.mark.parametrize("name", ["op4_source_mixing", "op10_token_counts"])
def test_columns(spark, name):
    df = QUERIES[name](spark, SF01)
    assert set(COLUMNS[name.split("_")[0]]) <= set(df.columns)
