"""Every registered query against its SQL twin, on whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(entry.own_queries()) == set(entry.own_sql())


@pytest.mark.parametrize("name", sorted(entry.own_queries()))
def test_equals_sql(spark, database, name):
    result = entry.own_queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = database.execute(entry.own_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    got = sorted(repr(tuple(r[c] for c in columns)) for r in result.collect())
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in expected.fetchall())
    assert got == want


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
