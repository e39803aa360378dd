"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from feedmart.llm import queries


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf_dir, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    want = con.sql(queries.ORACLE[key])
    got = queries.QUERIES[key](spark, sf_dir)
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = lambda cols, data: sorted(([r[cols.index(n)] for n in names] for r in data), key=str)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(list(want.columns), want.fetchall())
