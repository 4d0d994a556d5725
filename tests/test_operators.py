import pytest
from pyspark.sql import Observation

from conftest import rows
from tidelake.operators import (
    check_max_length,
    check_not_null,
    check_unique_key,
    clean,
    request_grid,
    roll_up,
    top1_per_class,
    top_k,
    top_n_dense,
    totals,
)


def test_top_k_breaks_ties_and_puts_nulls_last(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", None), ("d", 3)], "k string, v int")
    assert [r["k"] for r in top_k(df, "v", 4, ["k"]).collect()] == ["d", "a", "b", "c"]
    assert [r["k"] for r in top_k(df, "v", 2, ["k"]).collect()] == ["d", "a"]


def test_top_n_dense(spark):
    df = spark.createDataFrame([(n, v) for n, v in enumerate([9, 9, 7, 7, 7, 5, 4, None])], "k int, v int")
    assert sorted(r["v"] for r in top_n_dense(df, "v", 3).collect()) == [5, 7, 7, 7, 9, 9]


def test_top1_per_class(spark):
    df = spark.createDataFrame(
        [("x", "b", 5), ("x", "a", 5), ("x", "c", 4), ("y", "z", None), ("y", "q", 0), ("w", "n", None)],
        "c string, name string, v int",
    )
    got = rows(top1_per_class(df, "c", "v", "name"))
    assert got == [("w", "n", None), ("x", "a", 5), ("y", "q", 0)]


def test_roll_up_counts_every_link(spark):
    measures = spark.createDataFrame([(1, 10), (1, 5), (2, 1), (3, 100)], "k int, v long")
    links = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (4, "a")], "k int, t string")
    assert rows(totals(roll_up(measures, links, "k", "t", "v"), "t", "v")) == [("a", 16), ("b", 15)]


def test_clean_counts_what_it_drops(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, None)], "a int, b int")
    counts = Observation()
    assert rows(clean(df, ["a", "b"], observation=counts)) == [(1, 1)]
    assert counts.get == {"rows_read": 4, "rows_dropped_null": 2}


def test_clean_variants(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    assert rows(clean(df)) == [(1, None), (2, 3)]
    assert clean(df, dedupe=False).count() == 3


def test_checks(spark):
    df = spark.createDataFrame([(1, "abc"), (1, "abcd"), (None, None)], "id int, name string")
    assert rows(check_not_null(df, ["id", "name"])) == [("id", 1), ("name", 1)]
    assert rows(check_not_null(df.dropna(), ["id", "name"])) == []
    assert rows(check_unique_key(df, ["id"])) == [(1, 2)]
    assert rows(check_max_length(df, {"name": 3})) == [(1, "abcd")]


def test_request_grid(spark):
    days = spark.createDataFrame([("2021-01-01",), ("2021-01-02",)], "date string")
    got = rows(request_grid(days, {"shop": [1, 2]}, allowed=["date", "shop"]))
    assert got == [
        ("2021-01-01", 1, "2021-01-01", "2021-01-01+1"),
        ("2021-01-01", 2, "2021-01-01", "2021-01-01+2"),
        ("2021-01-02", 1, "2021-01-02", "2021-01-02+1"),
        ("2021-01-02", 2, "2021-01-02", "2021-01-02+2"),
    ]
    with pytest.raises(ValueError, match="daie"):
        request_grid(days.withColumnRenamed("date", "daie"), {}, allowed=["date"])
