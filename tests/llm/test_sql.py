"""Queries that SQL can express, against DuckDB on whole tables."""

import duckdb
import pytest

from millrace.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    names = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(names)
    key = lambda row: tuple((v is None, v) for v in row)
    rows = [tuple(r) for r in found.select(*names).collect()]
    assert sorted(rows, key=key) == sorted(expected.fetchall(), key=key)
