"""What is asked of Spark's JDBC reader and writer; no database runs here."""

from datetime import date
from unittest.mock import MagicMock

import pytest

from tidelake.sinks import write_jdbc
from tidelake.sources import extract_table, list_tables, read_table
from tidelake.sources import jdbc

URL, USER = "jdbc:postgresql://host/db", {"user": "u"}


def asked(spark):
    return spark.read.format.return_value.options.call_args.kwargs


def answering(row):
    spark = MagicMock()
    spark.read.format.return_value.options.return_value.load.return_value.first.return_value = row
    return spark


@pytest.mark.parametrize("low, high", [(1, 900), (date(2021, 1, 1), date(2021, 12, 31))])
def test_partitioned_read_asks_for_bounds(low, high):
    spark = answering((low, high))
    read_table(spark, URL, "rental", USER, partition_column="k", num_partitions=32)
    queries = [call.kwargs.get("query") for call in spark.read.format.return_value.options.call_args_list]
    assert queries[0] == "SELECT MIN(k) AS lo, MAX(k) AS hi FROM rental"
    assert asked(spark) == {
        "url": URL, "user": "u", "dbtable": "rental", "fetchsize": 10_000,
        "partitionColumn": "k", "lowerBound": str(low), "upperBound": str(high), "numPartitions": 32,
    }


def test_given_bounds_and_an_empty_table():
    spark = MagicMock()
    read_table(spark, URL, "rental", USER, partition_column="k", num_partitions=4, bounds=(0, 8))
    assert spark.read.format.return_value.options.call_count == 1
    assert asked(spark)["upperBound"] == "8"
    empty = answering((None, None))
    read_table(empty, URL, "rental", USER, partition_column="k", num_partitions=4)
    assert "partitionColumn" not in asked(empty)


def test_predicates_and_plain_read():
    spark = MagicMock()
    read_table(spark, URL, "rental", USER, predicates=["a = 1", "a <> 1"])
    assert spark.read.jdbc.call_args.kwargs["predicates"] == ["a = 1", "a <> 1"]
    read_table(spark, URL, "rental", USER)
    assert asked(spark) == {"url": URL, "user": "u", "dbtable": "rental", "fetchsize": 10_000}


def test_tasks_follow_the_number_of_rows():
    spark = answering((2_500_000,))
    read_table(spark, URL, "orders", USER, spread_by=["a", "b"], rows_per_task=1_000_000)
    assert spark.read.format.return_value.options.call_args.kwargs["query"] == "SELECT COUNT(*) AS n FROM orders"
    assert [p[-8:] for p in spark.read.jdbc.call_args.kwargs["predicates"]] == [f", 3) = {k}" for k in range(3)]
    small = answering((7,))
    read_table(small, URL, "orders", USER, spread_by=["a"])
    assert not small.read.jdbc.called and asked(small)["dbtable"] == "orders"


def test_conditions_take_every_row_once_and_spread_hot_values(spark, monkeypatch):
    """As Spark evaluates them; a third of the rows share one product, some columns are null."""
    rows_ = [(1 if n % 3 == 0 else n, None if n % 5 == 0 else n * 7, -n) for n in range(3000)]
    frame = spark.createDataFrame(rows_, "product_id int, client_id int, store_id int")
    monkeypatch.setattr(jdbc, "_jdbc", lambda *args, **options: spark.createDataFrame([(frame.count(),)], "n long"))
    sizes = [frame.filter(c).count() for c in jdbc.spread(spark, URL, "orders", frame.columns, USER, 500)]
    assert len(sizes) == 6 and sum(sizes) == 3000 and max(sizes) < 750


def test_list_tables_quotes_the_schema():
    spark = MagicMock()
    list_tables(spark, URL, USER, schema="o'x")
    assert "table_schema = 'o''x'" in asked(spark)["query"]


def test_extract_slices_only_listed_tables(spark, monkeypatch):
    frame = spark.createDataFrame([(1, date(2021, 1, 1)), (2, date(2021, 1, 2))], "id int, order_date date")
    monkeypatch.setattr(jdbc, "read_table", lambda *args, **kwargs: frame)
    assert extract_table(spark, URL, "public.orders", date(2021, 1, 2), USER).count() == 1
    assert extract_table(spark, URL, "public.clients", date(2021, 1, 2), USER).count() == 2


def test_the_database_makes_the_slice(spark, monkeypatch):
    """So that strides lie between the bounds of the slice."""
    asked = []
    frame = spark.createDataFrame([(1, date(2021, 1, 2))], "id int, order_date date")
    monkeypatch.setattr(jdbc, "read_table", lambda _spark, _url, table, _user, **options: asked.append((table, options)) or frame)
    extract_table(spark, URL, "public.orders", date(2021, 1, 2), USER, partition_column="product_id", num_partitions=8)
    assert asked == [
        ("(SELECT * FROM public.orders WHERE order_date = DATE '2021-01-02') AS day_rows", {"partition_column": "product_id", "num_partitions": 8})
    ]


def test_a_range_is_one_slice(spark, monkeypatch):
    asked = []
    frame = spark.createDataFrame([(1, date(2021, 1, 2)), (2, date(2021, 1, 9))], "id int, order_date date")
    monkeypatch.setattr(jdbc, "read_table", lambda _spark, _url, table, _user, **options: asked.append(table) or frame)
    assert extract_table(spark, URL, "public.orders", date(2021, 1, 1), USER, last=date(2021, 1, 3)).count() == 1
    assert asked == ["(SELECT * FROM public.orders WHERE order_date BETWEEN DATE '2021-01-01' AND DATE '2021-01-03') AS day_rows"]


def test_write_modes():
    df = MagicMock()
    write_jdbc(df, URL, "dim_stores", USER, "overwrite", batch_size=1000)
    kwargs = df.repartition.return_value.write.jdbc.call_args.kwargs
    assert kwargs["properties"]["truncate"] == "true" and kwargs["properties"]["batchsize"] == "1000"
    write_jdbc(df, URL, "orders", USER, "append")
    assert "truncate" not in df.repartition.return_value.write.jdbc.call_args.kwargs["properties"]
    with pytest.raises(ValueError):
        write_jdbc(df, URL, "orders", USER, "ignore")
