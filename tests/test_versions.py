"""Publishing by switch, dense ranks of all rows, and dedupe of wide rows."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidelake.operators import check_unique_key, dense_ranks, distinct_rows, skew, wide
from tidelake.sinks import versions
from tidelake.sinks.versions import publish


@pytest.fixture
def view(spark, tmp_path):
    name = f"db_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield f"{name}.dim"
    spark.sql(f"DROP DATABASE {name} CASCADE")


def frame(spark, *items):
    return spark.createDataFrame(list(items), "id int, name string")


def test_readers_see_one_version(spark, tmp_path, view):
    root = str(tmp_path / "dim")
    first = publish(frame(spark, (1, "a"), (2, "b")), root, view)
    reader = spark.table(view)
    second = publish(frame(spark, (3, "c")), root, view)
    assert rows(spark.table(view)) == [(3, "c")] and rows(reader) == [(1, "a"), (2, "b")]
    assert versions.versions(spark, root) == [first, second]
    for n in range(3):
        publish(frame(spark, (n, "x")), root, view)
    assert rows(spark.table(view)) == [(2, "x")] and len(versions.versions(spark, root)) == 3
    assert publish(frame(spark), root, view) and rows(spark.table(view)) == []


def test_a_failed_load_leaves_the_old_table(spark, tmp_path, view, monkeypatch):
    root = str(tmp_path / "dim")
    publish(frame(spark, (1, "a")), root, view)
    with pytest.raises(ValueError, match="row_cnt"):
        publish(frame(spark, (2, "b"), (2, "c")), root, view, check=lambda df: check_unique_key(df, ["id"]))
    assert rows(spark.table(view)) == [(1, "a")]
    # Between write and switch.
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (_ for _ in ()).throw(OSError("lost")) if "REPLACE VIEW" in text else sql(self, text, *a, **k))
    with pytest.raises(OSError):
        publish(frame(spark, (3, "d")), root, view)
    monkeypatch.undo()
    assert rows(spark.table(view)) == [(1, "a")]
    broken = frame(spark, (4, "e")).withColumn("name", F.raise_error(F.lit("in a task")).cast("string"))
    with pytest.raises(Exception, match="in a task"):
        publish(broken, root, view)
    assert rows(spark.table(view)) == [(1, "a")]
    publish(frame(spark, (5, "f")), root, view, check=lambda df: check_unique_key(df, ["id"]))
    assert rows(spark.table(view)) == [(5, "f")]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_dense_ranks(spark, conf, physical_plan, broadcast):
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    r = random.Random(1)
    values = [None if r.random() < 0.1 else 7 if r.random() < 0.3 else r.randint(-500, 500) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, value int")
    order = {v: n for n, v in enumerate(sorted({v for v in values if v is not None}, reverse=True), 1)}
    got = dense_ranks(df, "value")
    assert sorted((x.id, x["rank"]) for x in got.collect()) == [(n, order.get(v, len(order) + 1)) for n, v in enumerate(values)]
    assert "SinglePartition" not in physical_plan(got) and "Window" not in physical_plan(got)
    assert dense_ranks(df.limit(0), "value").count() == 0
    assert {x["rank"] for x in dense_ranks(df.filter("value IS NULL"), "value").collect()} == {1}


@pytest.mark.parametrize("few_bits", [False, True])
def test_distinct_rows(spark, tmp_path, monkeypatch, few_bits):
    if few_bits:
        # Digests that are often equal where rows are not.
        monkeypatch.setattr(wide, "_digests", lambda columns: [F.lit(1).alias("_a"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(3)).alias("_b")])
    items = [(n % 7, None if n % 5 == 0 else "x" * (n % 3) * 100, "y" if n % 2 else None) for n in range(200)] + [(None, "1", None), (1, None, None), (None, None, "1")]
    df = spark.createDataFrame(items, "id int, `a.b` string, text string")
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    assert rows(distinct_rows(spark, str(tmp_path / "t"))) == rows(df.distinct())
    assert rows(distinct_rows(spark, str(tmp_path / "t"), ["text"])) == rows(df.select("text").distinct())
    df.limit(0).write.parquet(str(tmp_path / "none"))
    assert distinct_rows(spark, str(tmp_path / "none")).count() == 0


def test_rows_are_not_shuffled(spark, tmp_path, physical_plan):
    spark.range(1000).selectExpr("id % 990 AS id", "repeat('wide', 100) AS text").write.parquet(str(tmp_path / "t"))
    got = distinct_rows(spark, str(tmp_path / "t"))
    assert got.count() == 990
    plan = physical_plan(got)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
