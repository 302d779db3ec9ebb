"""Queries that SQL can express, against it."""
import duckdb
import pytest

from cairn.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("pages", "conversations", "documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = queries.queries()[name](spark, sf)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)
