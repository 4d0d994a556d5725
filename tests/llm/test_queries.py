"""Registered queries against their SQL twins."""

import os

import duckdb
import pytest

from tidelake.llm import queries

TABLES = ["documents", "benchmark", "labels", "conversations", "embeddings"]


@pytest.mark.parametrize("sf", os.environ.get("LLM_TWIN_SF", "sf0.001").split(","))
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name, sf):
    sf_dir = f"/root/testdata/{sf}"
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = queries.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    expected = database.execute(queries.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    got = sorted(repr(tuple(r[c] for c in columns)) for r in result.collect())
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in expected.fetchall())
    assert got == want
