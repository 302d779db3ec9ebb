"""Every catalog query against its SQL, on the smallest tables."""
import duckdb
import pytest

from cairn.plans import catalog_queries as Q
from cairn.plans import control_queries, curated_queries, lifecycle_queries, stage_queries, sync_queries

assert stage_queries.query is control_queries.query is curated_queries.query is lifecycle_queries.query is sync_queries.query is Q.query  # all register their queries in one place

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return v
    try:
        return round(float(v), 6)
    except (TypeError, ValueError):
        return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in data], key=str)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_its_sql(spark, sf, con, name):
    got = Q.QUERIES[name](spark, sf)
    want = con.execute(Q.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLES)))
def test_query_without_sql_runs(spark, sf, name):
    assert Q.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["p_partkey", "reasons", "flags", "route"]
