"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, SQL = entry.own_queries(), entry.own_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/sf0.001/{table}.parquet'")
    return connection


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(row[i] for i in order) for row in values) if None not in {v for r in values for v in r} else sorted(
        (tuple(row[i] for i in order) for row in values), key=repr
    )


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, f"{TESTDATA}/sf0.001")
    want = duck.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


def test_entry_point(spark):
    assert entry.entry(spark).columns == ["split", "window_id", "x", "y"]
