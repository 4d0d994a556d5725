"""Gold tables: results, DDL, constraints and repeated loads."""

from datetime import date

import pytest

from conftest import rows
from tidelake.plans import star
from tidelake.schemas import SHOP_SCHEMAS, STAR_SCHEMA
from tidelake.sinks import create_star_schema, find_violations, load_dimension, load_fact

DAY = date(2021, 1, 1)


def frame(spark, table, *data):
    return spark.createDataFrame(list(data), SHOP_SCHEMAS[table])


def test_fact_orders_adds_differing_rows(spark):
    orders = frame(spark, "orders", (1, 2, 3, 1, DAY), (1, 2, 3, 2, DAY), (1, 2, 3, 4, DAY), (1, 2, 3, 9, date(2021, 1, 2)))
    assert rows(star.fact_orders(orders, DAY)) == [(DAY, 2, 1, 3, 7)]
    assert star.fact_orders(orders).count() == 2


def test_dimensions_keep_rows_without_a_match(spark):
    areas = frame(spark, "location_areas", (1, "north"))
    products = star.dim_products(
        frame(spark, "products", (1, "p", 1, 9), (2, "q", None, 1)),
        frame(spark, "departments", (1, "d")),
        frame(spark, "aisles", (1, "a")),
    )
    assert rows(products) == [(1, "p", "d", None), (2, "q", None, "a")]
    stores = star.dim_stores(
        frame(spark, "stores", (1, 1, 1), (2, 5, None)), frame(spark, "store_types", (1, "big")), areas
    )
    assert rows(stores) == [(1, "big", "north"), (2, None, None)]
    clients = star.dim_clients(frame(spark, "clients", (1, "x y", 1), (2, "z", 4)), areas)
    assert rows(clients) == [(1, "x y", "north"), (2, "z", None)]


def test_find_violations(spark):
    good = [(1, "p", "d", "a")]
    bad = [(2, "x" * 256, None, None), (2, "p", None, None), (None, "p", None, None)]
    table = STAR_SCHEMA["dim_products"]
    schema = "product_id int, product_name string, department string, aisle string"
    assert rows(find_violations(spark.createDataFrame(good, schema), table)) == []
    assert rows(find_violations(spark.createDataFrame(good + bad, schema), table)) == [
        ("max_length", "product_name", 1),
        ("not_null", "product_id", 1),
        ("unique_key", "product_id", 1),
    ]


@pytest.fixture
def warehouse(spark, tmp_path):
    name = f"gold_{tmp_path.name.replace('-', '_')}"
    create_star_schema(spark, name, str(tmp_path / "gold"), buckets=4)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_fact_load_replaces_its_days(spark, warehouse):
    schema = "client_id int, quantity long, product_id int, store_id int, order_date date"
    first = spark.createDataFrame([(n, 1, n, n % 3, date(2021, 1, 1 + n % 2)) for n in range(20)], schema)
    load_fact(first, warehouse, "orders")
    load_fact(first, warehouse, "orders")
    table = spark.table(f"{warehouse}.orders")
    assert table.count() == 20
    assert dict(table.dtypes)["quantity"] == "int"
    load_fact(spark.createDataFrame([(1, 5, 1, 1, date(2021, 1, 2))], schema), warehouse, "orders")
    spark.catalog.refreshTable(f"{warehouse}.orders")
    assert rows(spark.table(f"{warehouse}.orders").groupBy("order_date").sum("quantity")) == [
        (date(2021, 1, 1), 10), (date(2021, 1, 2), 5),
    ]


def test_a_new_schema_starts_empty(spark, warehouse):
    schema = "id int, fullname string, area string"
    load_dimension(spark.createDataFrame([(1, "a", "n")], schema), warehouse, "dim_clients")
    load_fact(spark.createDataFrame([(DAY, 1)], "date date, product_id int"), warehouse, "out_of_stock")
    create_star_schema(spark, warehouse, buckets=4)
    assert spark.table(f"{warehouse}.dim_clients").isEmpty()
    assert spark.table(f"{warehouse}.out_of_stock").isEmpty()


def test_grouping_by_the_bucket_column_needs_no_shuffle(spark, warehouse, physical_plan):
    data = [(n, 1, n, n % 3, DAY) for n in range(20)]
    load_fact(spark.createDataFrame(data, "client_id int, quantity long, product_id int, store_id int, order_date date"), warehouse, "orders")
    per_store = spark.table(f"{warehouse}.orders").groupBy("store_id").sum("quantity")
    assert "Exchange" not in physical_plan(per_store)
    assert per_store.count() == 3


def test_a_null_in_a_required_column_fails_the_load(spark, warehouse):
    feed = spark.createDataFrame([(DAY, 1), (DAY, None)], "date date, product_id int")
    with pytest.raises(Exception, match="out_of_stock.product_id is null"):
        load_fact(feed, warehouse, "out_of_stock")
    assert spark.table(f"{warehouse}.out_of_stock").count() == 0


def test_dimension_load(spark, warehouse):
    schema = "id int, fullname string, area string"
    load_dimension(spark.createDataFrame([(1, "a", "n"), (2, "b", None)], schema), warehouse, "dim_clients")
    load_dimension(spark.createDataFrame([(1, "c", "n")], schema), warehouse, "dim_clients")
    spark.catalog.refreshTable(f"{warehouse}.dim_clients")
    assert rows(spark.table(f"{warehouse}.dim_clients")) == [(1, "c", "n")]
    with pytest.raises(ValueError, match="1 of unique_key on id"):
        load_dimension(spark.createDataFrame([(1, "a", "n"), (1, "b", "n")], schema), warehouse, "dim_clients")
    with pytest.raises(ValueError, match="1 of max_length on fullname"):
        load_dimension(spark.createDataFrame([(1, "a" * 64, "n")], schema), warehouse, "dim_clients")
    with pytest.raises(Exception, match="dim_clients.id is null"):
        load_dimension(spark.createDataFrame([(None, "a", "n")], schema), warehouse, "dim_clients")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_value_beyond_its_column_is_an_error(spark, warehouse, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    wide = spark.createDataFrame([(4294967301, "x", "y", "z")], "product_id long, product_name string, department string, aisle string")
    with pytest.raises(Exception, match="dim_products.product_id does not fit: 4294967301"):
        load_dimension(wide, warehouse, "dim_products")
