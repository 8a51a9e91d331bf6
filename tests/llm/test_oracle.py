"""Queries that SQL can express, against DuckDB on whole tables."""

from collections import Counter

import duckdb
import pytest

from tallymill.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(want.columns)
    rows = Counter(tuple(r) for r in got.select(want.columns).collect())
    assert rows and rows == Counter(want.fetchall())
