"""Registered queries against their SQL in DuckDB, on the smallest tables."""
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SQL, QUERIES = oracle_sql(), queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1.1e-6)
    return a == b and type(a) is type(b)


@pytest.mark.parametrize("name", list(SQL))
def test_equal_to_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    expected = ordered(want.columns, want.fetchall())
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert all(close(x, y) for x, y in zip(g, e)), (g, e)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
