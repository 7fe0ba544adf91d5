"""The training-data queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from adlens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def values(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(f"{r[i]:.6g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_duckdb(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[key](spark, SF), con.sql(ORACLE[key])
    assert sorted(got.columns) == sorted(want.columns)
    assert values([tuple(r) for r in got.collect()], got.columns) == values(want.fetchall(), want.columns)
