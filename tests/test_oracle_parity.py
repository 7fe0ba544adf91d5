"""Every registered query against its DuckDB oracle on the smallest TESTDATA."""

import duckdb
import pytest

import __spark_entry__ as E
from adlens.plans.registry import QUERIES
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
KEYS = sorted(QUERIES)  # the library's own keys; those of adlens/llm are tested in tests/llm


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) and set(KEYS) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[key])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, rel.columns)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total" in df.columns
