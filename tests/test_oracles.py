"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF01
from capset.plans import ORACLES, QUERIES
from tools.oracle_check import TABLES, canon


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLES)
    assert not rows_only, rows_only


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    srows, scols = df.collect(), df.columns
    cur = con.execute(ORACLES[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    c1, r1 = canon(scols, srows)
    c2, r2 = canon(dcols, drows)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["folder", "lang", "n_pending", "caption_chars", "n_short", "first_key", "last_key"]
