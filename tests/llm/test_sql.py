"""Operators that SQL can express, against DuckDB over the small test tables."""

import duckdb
import pytest

from ledgerline.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF).select(*columns)
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)
