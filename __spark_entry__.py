"""

The driver's tables stand in for the rental and shop schemas; the functions at the
top rename their columns, the queries call the library.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidelake.functions import contains, exclusive_class, overlapping_classes, starts_with
from tidelake.operators import (
    check_max_length,
    check_not_null,
    check_unique_key,
    clean,
    dense_ranks,
    distinct_rows,
    lookup_join,
    request_grid,
    roll_up,
    top1_per_class,
    totals,
)
from tidelake.plans import rental, star
from tidelake.plans.changed import run_changed
from tidelake.plans.jobs import GOLD_FACTS, Lake, clean_out_of_stock, clean_shop_table, gold_rows, run_range
from tidelake.schemas import WritePolicy, write_policy
from tidelake.session import scratch_dir, staged
from tidelake.sinks import create_star_schema, load_dimension, load_fact, write_csv, write_json, write_table
from tidelake.sinks.versions import publish
from tidelake.sources.evolving import SchemaLedger
from tidelake.sources import DAY_FOLDERS, day_slice, read_bronze_csv, read_bronze_json, read_silver
from tidelake.streaming import ingest_feed, take_landed

# The subpackage is optional; one that is there must import.
_llm = importlib.util.find_spec("tidelake.llm")
llm_queries = importlib.import_module("tidelake.llm.queries") if _llm and _llm.origin else None

FEED_SCHEMA = T.StructType([T.StructField("date", T.DateType()), T.StructField("product_id", T.LongType())])
REGION_CLASSES = {"starts_with_a": starts_with("a"), "contains_e": contains("E")}
ONE_BY_DAY = WritePolicy("append", "date")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _renamed(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for new, old in columns.items()])


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the out-of-stock feed."""
    return _table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), F.col("user_id").alias("product_id"))


def _lines_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _renamed(
        _table(spark, sf_dir, "orders"), l_orderkey="o_orderkey", o_custkey="o_custkey", o_orderdate="o_orderdate"
    )
    return lookup_join(_table(spark, sf_dir, "lineitem"), orders, "l_orderkey")


def _shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_with_orders(spark, sf_dir).select(
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("client_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )


def _suppliers_as_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(_table(spark, sf_dir, "supplier"), actor_id="s_suppkey", first_name="s_name", last_name="s_name")


# Rental questions


def category_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    film_category = _renamed(_table(spark, sf_dir, "customer"), category_id="c_nationkey")
    category = _renamed(_table(spark, sf_dir, "nation"), category_id="n_nationkey", name="n_name")
    return rental.films_per_category(film_category, category).withColumnRenamed("film_cnt", "item_cnt")


def topk_entities_by_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    top = rental.most_rented_actors(
        _renamed(orders, inventory_id="o_orderkey"),
        _renamed(orders, inventory_id="o_orderkey", film_id="o_orderkey"),
        _renamed(_table(spark, sf_dir, "lineitem"), film_id="l_orderkey", actor_id="l_suppkey"),
        _suppliers_as_actors(spark, sf_dir),
    )
    return _renamed(top, s_suppkey="actor_id", s_name="first_name", link_cnt="total_rental")


def topk_entities_by_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts repeat on both sides: every supplier of a part counts all its order lines."""
    lines = _table(spark, sf_dir, "lineitem")
    top = rental.most_rented_actors(
        _renamed(_table(spark, sf_dir, "orders"), inventory_id="o_orderkey"),
        _renamed(lines, inventory_id="l_orderkey", film_id="l_partkey"),
        _renamed(lines, film_id="l_partkey", actor_id="l_suppkey"),
        _suppliers_as_actors(spark, sf_dir),
    )
    return _renamed(top, s_suppkey="actor_id", s_name="first_name", link_cnt="total_rental")


def top1_category_by_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = rental.top_category_by_amount(
        _table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("rental_id"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount")
        ),
        _renamed(_table(spark, sf_dir, "orders"), rental_id="o_orderkey", inventory_id="o_custkey"),
        _renamed(_table(spark, sf_dir, "customer"), inventory_id="c_custkey", film_id="c_nationkey"),
        _renamed(_table(spark, sf_dir, "nation"), film_id="n_nationkey", category_id="n_regionkey"),
        _renamed(_table(spark, sf_dir, "region"), category_id="r_regionkey", name="r_name"),
    )
    return top.select("name", F.col("total_amount").cast("double").alias("total_amount"))


def unreferenced_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of which no lot of 50 came back."""
    film = _renamed(_table(spark, sf_dir, "part"), film_id="p_partkey", title="p_name")
    returned = _table(spark, sf_dir, "lineitem").filter("l_quantity > 49 AND l_returnflag = 'R'")
    return rental.films_not_in_inventory(film, _renamed(returned, film_id="l_partkey")).withColumnRenamed(
        "title", "p_name"
    )


def dense_rank_top3_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    top = rental.top_actors_in_category(
        _renamed(_table(spark, sf_dir, "lineitem"), film_id="l_partkey", actor_id="l_suppkey"),
        _renamed(part, film_id="p_partkey", category_id="p_type"),
        staged(_renamed(part, category_id="p_type", name="p_type").distinct(), "category"),
        _suppliers_as_actors(spark, sf_dir),
        name="ECONOMY",
    )
    return _renamed(top, s_name="first_name", item_cnt="film_cnt")


def active_inactive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    customer = _table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("address_id"), F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("active")
    )
    return rental.customers_per_city(
        customer,
        _renamed(nation, address_id="n_nationkey", city_id="n_nationkey"),
        _renamed(nation, city_id="n_nationkey", city="n_name"),
    )


def _top_priority_per_region_class(spark: SparkSession, sf_dir: str, exclusive: bool) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    rows = roll_up(
        lines, _table(spark, sf_dir, "orders"), "o_orderkey", ["o_custkey", "o_orderpriority"], "quantity", to_one=True
    ).withColumnRenamed("o_custkey", "c_custkey")
    carry = "o_orderpriority"
    rows = roll_up(rows, _table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey", "quantity", carry, to_one=True)
    rows = rows.withColumnRenamed("c_nationkey", "n_nationkey")
    rows = roll_up(rows, _table(spark, sf_dir, "nation"), "n_nationkey", "n_regionkey", "quantity", carry, to_one=True)
    rows = rows.withColumnRenamed("n_regionkey", "r_regionkey")
    region = _table(spark, sf_dir, "region")
    if exclusive:
        classes = region.select("r_regionkey", exclusive_class(F.col("r_name"), REGION_CLASSES).alias("class"))
        classes = classes.filter("class IS NOT NULL")
    else:
        classes = region.select(
            "r_regionkey", F.explode(overlapping_classes(F.col("r_name"), REGION_CLASSES)).alias("class")
        )
    rows = roll_up(rows, classes, "r_regionkey", "class", "quantity", carry)
    rows = rows.withColumnRenamed("o_orderpriority", "category").withColumnRenamed("quantity", "total_quantity")
    return top1_per_class(totals(rows, ["class", "category"], "total_quantity"), "class", "total_quantity", "category")


def top1_per_class_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_priority_per_region_class(spark, sf_dir, exclusive=True)


def top1_per_class_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_priority_per_region_class(spark, sf_dir, exclusive=False)


def _lines_as_rentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(
        _lines_with_orders(spark, sf_dir),
        rental_id="l_orderkey",
        inventory_id="l_partkey",
        customer_id="o_custkey",
        rental_date="o_orderdate",
        return_date="l_shipdate",
    )


def _top_brand_hours(spark: SparkSession, sf_dir: str, exclusive: bool, resolution: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    return rental.top_category_per_city_class(
        _lines_as_rentals(spark, sf_dir),
        _renamed(part, inventory_id="p_partkey", film_id="p_partkey"),
        _renamed(part, film_id="p_partkey", category_id="p_brand"),
        _renamed(part, category_id="p_brand", name="p_brand").distinct(),
        _renamed(_table(spark, sf_dir, "customer"), customer_id="c_custkey", address_id="c_nationkey"),
        _renamed(_table(spark, sf_dir, "nation"), address_id="n_nationkey", city_id="n_regionkey"),
        _renamed(_table(spark, sf_dir, "region"), city_id="r_regionkey", city="r_name"),
        rules=REGION_CLASSES,
        exclusive=exclusive,
        resolution=resolution,
        rental_keys=_renamed(_table(spark, sf_dir, "orders"), customer_id="o_custkey"),
    )


def top1_hours_exclusive_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_brand_hours(spark, sf_dir, exclusive=True, resolution="minute")


def top1_hours_overlap_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_brand_hours(spark, sf_dir, exclusive=False, resolution="second")


def rental_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rental.rental_hours(_lines_as_rentals(spark, sf_dir), "rental_id").withColumnRenamed(
        "rental_id", "o_orderkey"
    )


def event_hours_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from the last midnight to each event, with times of day that have seconds."""
    events = _table(spark, sf_dir, "events").select(
        "event_type", F.to_date("ts").cast("timestamp_ntz").alias("rental_date"), F.col("ts").alias("return_date")
    )
    return rental.rental_hours(events, "event_type", resolution="minute")


def event_hours_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select(
        "event_type", F.to_date("ts").cast("timestamp_ntz").alias("rental_date"), F.col("ts").alias("return_date")
    )
    return rental.rental_hours(events, "event_type", resolution="second")


# Silver


def silver_clean_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_feed(spark, sf_dir), not_null=["date", "product_id"])


def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


def orders_day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_slice(_table(spark, sf_dir, "orders"), "o_orderdate", date(1998, 10, 3))


def request_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _feed(spark, sf_dir).select("date").distinct()
    types = _table(spark, sf_dir, "events").select("event_type")
    return request_grid(days, {"event_type": types}, allowed=["date", "event_type"])


# Gold


def gold_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_orders(_shop_orders(spark, sf_dir))


def gold_fact_orders_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    on_day = _renamed(day_slice(orders, "o_orderdate", date(1998, 10, 3)), l_orderkey="o_orderkey", o_custkey="o_custkey")
    rows = lookup_join(_table(spark, sf_dir, "lineitem"), on_day, "l_orderkey").select(
        F.lit("1998-10-03").cast("date").alias("order_date"),
        F.col("o_custkey").alias("client_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    return star.fact_orders(rows)


def gold_fact_orders_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _renamed(_table(spark, sf_dir, "part"), l_partkey="p_partkey", product_id="p_size")
    supplier = _renamed(_table(spark, sf_dir, "supplier"), l_suppkey="s_suppkey", store_id="s_nationkey")
    customer = _renamed(_table(spark, sf_dir, "customer"), o_custkey="c_custkey", client_id="c_nationkey")
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    rows = lookup_join(_lines_with_orders(spark, sf_dir), part, "l_partkey", keys_from=lines)
    rows = lookup_join(rows, supplier, "l_suppkey", keys_from=lines)
    rows = lookup_join(rows, customer, "o_custkey", keys_from=orders)
    rows = rows.select(
        F.to_date("o_orderdate").alias("order_date"),
        "client_id",
        "product_id",
        "store_id",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.lit(1).cast("bigint").alias("row_cnt"),
    )
    return totals(rows, ["order_date", "client_id", "product_id", "store_id"], ["quantity", "row_cnt"])


def gold_dim_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = _renamed(
        _table(spark, sf_dir, "customer"), id="c_custkey", fullname="c_name", location_area_id="c_nationkey"
    )
    nation = _renamed(_table(spark, sf_dir, "nation").filter("n_nationkey < 20"), area_id="n_nationkey", key="n_regionkey")
    region = _renamed(_table(spark, sf_dir, "region"), key="r_regionkey", area="r_name")
    return star.dim_clients(clients, lookup_join(nation, region, "key"))


def gold_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    products = _renamed(part, product_id="p_partkey", product_name="p_name", department_id="p_type", aisle_id="p_brand")
    departments = _renamed(part.filter("p_type <> 'SMALL'"), department_id="p_type", department="p_type").distinct()
    aisles = _renamed(part, aisle_id="p_brand", aisle="p_brand").distinct()
    return star.dim_products(products, staged(departments, "departments"), staged(aisles, "aisles"))


def gold_dim_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "nation")
    stores = lookup_join(
        _renamed(supplier, store_id="s_suppkey", store_type_id="s_nationkey"),
        _renamed(nation, store_type_id="n_nationkey", location_area_id="n_regionkey"),
        "store_type_id",
        "left",
    )
    store_types = _renamed(nation, store_type_id="n_nationkey", type="n_name")
    areas = _renamed(_table(spark, sf_dir, "region").filter("r_regionkey < 3"), area_id="r_regionkey", area="r_name")
    return star.dim_stores(stores, store_types, areas)


def gold_fact_out_of_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = day_slice(_table(spark, sf_dir, "events"), "ts", date(2024, 1, 5))
    rows = day.select(F.to_date("ts").alias("date"), F.col("user_id").alias("product_id"))
    return star.fact_out_of_stock(clean(rows, not_null=["date", "product_id"]))


# Checks


def check_not_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _renamed(_table(spark, sf_dir, "customer"), c_custkey="c_custkey", n_nationkey="c_nationkey")
    nation = _table(spark, sf_dir, "nation").filter("n_nationkey < 20").select("n_nationkey", "n_name")
    return check_not_null(lookup_join(customer, nation, "n_nationkey", "left"), ["c_custkey", "n_name"])


def check_unique_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique_key(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_max_length_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_max_length(_table(spark, sf_dir, "part").select("p_partkey", "p_name"), {"p_name": 10})


# Layers written and read back


def bronze_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    path = scratch_dir(spark, "bronze-csv")
    write_csv(customer, path)
    return read_bronze_csv(spark, path, customer.schema)


def bronze_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "bronze-json")
    write_json(_feed(spark, sf_dir), path)
    return read_bronze_json(spark, path, FEED_SCHEMA)


def bronze_wrapped_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "bronze-wrapped")
    write_json(_feed(spark, sf_dir), path, wrapped=True)
    return read_bronze_json(spark, path, FEED_SCHEMA, wrapped=True)


def feed_csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer in JSON, landed as CSV."""
    root = scratch_dir(spark, "feed-csv")
    write_json(_feed(spark, sf_dir), f"{root}/answer")
    write_csv(read_bronze_json(spark, f"{root}/answer", FEED_SCHEMA), f"{root}/csv")
    return read_bronze_csv(spark, f"{root}/csv", FEED_SCHEMA, multiline=False)


def _awkward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with blanks at both ends of a text, empty texts, nulls, and microseconds."""
    kind = F.col("event_type")
    text = F.when(kind == "view", "").when(kind != "click", F.concat(F.lit("  "), kind, F.lit(' "x", ')))
    return _table(spark, sf_dir, "events").select("event_id", text.alias("text"), F.col("ts").cast("timestamp_ntz").alias("ts"))


def bronze_csv_awkward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = _awkward(spark, sf_dir), scratch_dir(spark, "bronze-csv")
    write_csv(rows, path)
    return read_bronze_csv(spark, path, rows.schema)


def bronze_json_awkward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = _awkward(spark, sf_dir), scratch_dir(spark, "bronze-json")
    write_json(rows, path)
    return read_bronze_json(spark, path, rows.schema)


def _event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as orders of some thirty days, every row twice."""
    rows = _table(spark, sf_dir, "events").select(
        (F.col("user_id") % 50).alias("product_id"),
        F.col("user_id").alias("client_id"),
        F.length("event_type").cast("bigint").alias("store_id"),
        (F.col("event_id") % 100).alias("quantity"),
        F.to_date("ts").alias("order_date"),
    )
    return rows.union(rows)


def _event_lake(spark: SparkSession, sf_dir: str, database: str = "gold") -> tuple[Lake, date, date]:
    """A lake in which orders and feed have landed day by day, and its first and last day."""
    root = scratch_dir(spark, "lake")
    lake = Lake(f"{root}/bronze", f"{root}/silver", database, bronze_layout=DAY_FOLDERS)
    feed = _feed(spark, sf_dir)
    write_csv(_event_orders(spark, sf_dir), f"{lake.bronze}/{lake.source}/orders", day_column="order_date")
    write_json(feed, f"{lake.bronze}/{lake.feed}", day_column="date")
    first, last = feed.agg(F.min("date"), F.max("date")).first()
    return lake, first, last


def silver_shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed orders of all days to silver, in one range, and the first day a second time."""
    lake, first, last = _event_lake(spark, sf_dir)
    schemas = {"orders": _event_orders(spark, sf_dir).schema}
    clean_shop_table(spark, lake, "orders", first, last, schemas)
    clean_shop_table(spark, lake, "orders", first, schemas=schemas)
    return read_silver(spark, lake.silver_path("orders"), schemas["orders"])


def run_range_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and gold of all days in one run: the orders fact."""
    database = _new_warehouse(spark)
    lake, first, last = _event_lake(spark, sf_dir, database)
    schemas = {"orders": _event_orders(spark, sf_dir).schema, "out_of_stock": FEED_SCHEMA}
    run_range(spark, lake, first, last, schemas=schemas, gold_tables=GOLD_FACTS)
    return spark.table(f"{database}.orders")


def feed_days_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in silver and gold after its second day has come again as an empty list and its third as an error message."""
    database = _new_warehouse(spark)
    lake, first, last = _event_lake(spark, sf_dir, database)
    schemas = {"out_of_stock": FEED_SCHEMA}
    run_range(spark, lake, first, last, tables=[], schemas=schemas, gold_tables=["out_of_stock"])
    for n, body in ((1, "[]"), (2, '{"message": "no data"}')):
        day = first + timedelta(days=n)
        path = f"{lake.bronze}/{lake.feed}/as_of_date={day}"
        spark.createDataFrame([(body,)], "value string").write.mode("overwrite").text(path)
        run_range(spark, lake, day, tables=[], schemas=schemas, gold_tables=["out_of_stock"])
    silver = read_silver(spark, lake.silver_path("out_of_stock"), FEED_SCHEMA)
    gold = spark.table(f"{database}.out_of_stock")
    return silver.withColumn("layer", F.lit("silver")).unionByName(gold.withColumn("layer", F.lit("gold")))


def orders_bronze_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed CSV, cleaned into a table by day, added up for gold."""
    root = scratch_dir(spark, "orders-layers")
    orders = _shop_orders(spark, sf_dir)
    write_csv(orders, f"{root}/bronze")
    bronze = read_bronze_csv(spark, f"{root}/bronze", orders.schema, multiline=False)
    write_table(clean(bronze), f"{root}/silver", write_policy("orders"))
    return star.fact_orders(read_silver(spark, f"{root}/silver", orders.schema))


def backfill_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the feed landed in its folder, then loaded as one range, its first day a second time."""
    root = scratch_dir(spark, "backfill")
    lake = Lake(f"{root}/bronze", f"{root}/silver", bronze_layout=DAY_FOLDERS)
    feed = _feed(spark, sf_dir)
    write_json(feed, f"{lake.bronze}/{lake.feed}", day_column="date")
    first, last = feed.agg(F.min("date"), F.max("date")).first()
    clean_out_of_stock(spark, lake, first, last, FEED_SCHEMA)
    clean_out_of_stock(spark, lake, first, schema=FEED_SCHEMA)
    return gold_rows(spark, lake, "out_of_stock", first, last, {"out_of_stock": FEED_SCHEMA})


def warehouse_out_of_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed loaded into the star schema, its later days a second time."""
    database = _new_warehouse(spark)
    facts = star.fact_out_of_stock(clean(_feed(spark, sf_dir), not_null=["date", "product_id"]))
    load_fact(facts, database, "out_of_stock")
    load_fact(day_slice(facts, "date", date(2024, 1, 15), date(2024, 1, 30)), database, "out_of_stock")
    return spark.table(f"{database}.out_of_stock")


def warehouse_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dimension loaded into the star schema twice."""
    database = _new_warehouse(spark)
    for _ in range(2):
        load_dimension(gold_dim_products(spark, sf_dir), database, "dim_products")
    return spark.table(f"{database}.dim_products")


def _new_warehouse(spark: SparkSession) -> str:
    """A database of its own with an empty star schema."""
    root = scratch_dir(spark, "warehouse")
    database = root.rsplit("/", 1)[-1].replace("-", "_")
    create_star_schema(spark, database, root, day_bytes={"orders": 1 << 20, "out_of_stock": 1 << 20})
    return database


def silver_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, then the days from 2024-01-15 a second time: nothing doubles."""
    path = scratch_dir(spark, "silver-append")
    rows = clean(_feed(spark, sf_dir), not_null=["date", "product_id"])
    write_table(rows, path, ONE_BY_DAY)
    write_table(day_slice(rows, "date", date(2024, 1, 15), date(2024, 1, 30)), path, ONE_BY_DAY)
    return read_silver(spark, path)


def silver_static_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, then the days from 2024-01-15 as the new whole table."""
    path = scratch_dir(spark, "silver-static")
    policy = WritePolicy("overwrite", "date")
    rows = clean(_feed(spark, sf_dir), not_null=["date", "product_id"])
    write_table(rows, path, policy)
    write_table(rows.filter(F.col("date") >= F.lit(date(2024, 1, 15))), path, policy)
    return read_silver(spark, path)


def silver_snapshot_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the orders in a row: the second replaces the first."""
    path = scratch_dir(spark, "silver-snapshot")
    orders = _table(spark, sf_dir, "orders")
    write_table(orders, path, WritePolicy("overwrite"))
    write_table(clean(orders.drop("o_totalprice")), path, WritePolicy("overwrite"))
    return read_silver(spark, path)


def silver_day_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partition of the silver feed, read from the table's root."""
    path = scratch_dir(spark, "silver-day")
    write_table(clean(_feed(spark, sf_dir), not_null=["date", "product_id"]), path, ONE_BY_DAY)
    return read_silver(spark, path, date_column="date", start=date(2024, 1, 5))


def stream_ingest_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed lands in two parts that share days and rows; each call takes what is new."""
    root = scratch_dir(spark, "stream")
    events = _table(spark, sf_dir, "events")
    for part, rows in enumerate((events.filter("event_type <> 'view'"), events.filter("event_type <> 'click'"))):
        feed = rows.select(F.to_date("ts").alias("date"), F.col("user_id").alias("product_id"))
        write_json(feed, f"{root}/landing/part-{part}")
        ingest_feed(spark, f"{root}/landing/*", f"{root}/silver", f"{root}/checkpoint", FEED_SCHEMA)
    return read_silver(spark, f"{root}/silver")


def documents_csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks and quotes as CSV, every file read by many tasks."""
    documents, path = _table(spark, sf_dir, "documents"), scratch_dir(spark, "documents-csv")
    write_csv(documents, path)
    return read_bronze_csv(spark, path, documents.schema, multiline=True, block_bytes=1 << 20)


def _land_one_array(rows: DataFrame, path: str, day_column: str) -> None:
    """A file for each day that is one array of the day's rows on one line, as the feed's downloader writes it; a day's rows pass by its one writer."""
    numbered = rows.withColumn("nth", F.row_number().over(Window.partitionBy(day_column).orderBy(*rows.columns)))
    text = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    numbered = numbered.select(F.col(day_column).alias("as_of_date"), "nth", F.concat(F.when(F.col("nth") == 1, "[").otherwise(","), text).alias("value"))
    ends = rows.select(F.col(day_column).alias("as_of_date")).distinct().select("as_of_date", F.lit(2**31 - 1).alias("nth"), F.lit("]").alias("value"))
    lines = numbered.unionByName(ends).repartition("as_of_date").sortWithinPartitions("as_of_date", "nth")
    lines.select("as_of_date", "value").write.partitionBy("as_of_date").option("lineSep", " ").text(path)


def feed_one_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed landed as one array a day, every file read by many tasks, into silver."""
    root = scratch_dir(spark, "feed-arrays")
    feed = _feed(spark, sf_dir)
    _land_one_array(feed.filter("date IS NOT NULL"), root, "date")
    return clean(read_bronze_json(spark, root, FEED_SCHEMA, multiline=True, block_bytes=1 << 16), ["date", "product_id"])


def feed_rewritten_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed lands by day and is taken; its second day lands again without views, its third without rows, and is taken again."""
    root = scratch_dir(spark, "landed")
    feed = _table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), F.col("user_id").alias("product_id"), "event_type")
    write_json(feed.drop("event_type"), f"{root}/landing", day_column="date")
    first = feed.agg(F.min("date")).first()[0]
    second, third = first + timedelta(days=1), first + timedelta(days=2)
    for step in range(2):
        take_landed(spark, f"{root}/landing", f"{root}/silver", f"{root}/state", FEED_SCHEMA, DAY_FOLDERS)
        if not step:
            write_json(feed.filter((F.col("date") == F.lit(second)) & (F.col("event_type") != "view")).drop("event_type"), f"{root}/landing", day_column="date")
            spark.createDataFrame([("[]",)], "value string").write.mode("overwrite").text(f"{root}/landing/as_of_date={third}")
    return read_silver(spark, f"{root}/silver", FEED_SCHEMA)


def range_changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days to gold; the orders of one day land again with other quantities; of the second run only that day is written. With how often each was."""
    database = _new_warehouse(spark)
    lake, first, last = _event_lake(spark, sf_dir, database)
    schemas = {"orders": _event_orders(spark, sf_dir).schema, "out_of_stock": FEED_SCHEMA}
    corrected = first + timedelta(days=1)
    runs = [run_changed(spark, lake, first, last, schemas=schemas, gold_tables=GOLD_FACTS)]
    orders = _event_orders(spark, sf_dir).filter(F.col("order_date") == F.lit(corrected)).withColumn("quantity", F.col("quantity") + 1000)
    write_csv(orders, f"{lake.bronze}/{lake.source}/orders", day_column="order_date")
    runs += [run_changed(spark, lake, first, last, schemas=schemas, gold_tables=GOLD_FACTS) for _ in range(2)]
    written = [(day,) for run in runs for day in run.gold.get("orders", [])]
    times = spark.createDataFrame(written, "order_date date").groupBy("order_date").agg(F.count("*").alias("times_written"))
    # A row for each calendar day.
    return spark.table(f"{database}.orders").join(F.broadcast(times), "order_date")


def orders_columns_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that land with a narrow quantity first, then with columns in another order, a wider quantity and a channel; one readable table."""
    root = scratch_dir(spark, "columns")
    lake = Lake(f"{root}/bronze", f"{root}/silver", bronze_layout=DAY_FOLDERS)
    orders = _event_orders(spark, sf_dir)
    first, last = orders.agg(F.min("order_date"), F.max("order_date")).first()
    turn, path = first + timedelta(days=10), f"{lake.bronze}/{lake.source}/orders"
    old = T.StructType([f if f.name != "quantity" else T.StructField("quantity", T.IntegerType()) for f in orders.schema])
    new = T.StructType([*orders.schema, T.StructField("channel", T.StringType())])
    later = orders.filter(F.col("order_date") >= F.lit(turn)).withColumns({"quantity": F.col("quantity") + 2**40, "channel": F.concat(F.lit("c"), F.col("store_id"))})
    write_csv(orders.filter(F.col("order_date") < F.lit(turn)), path, day_column="order_date")
    write_csv(later.select("channel", "order_date", "quantity", "client_id", "store_id", "product_id"), path, day_column="order_date")
    ledger = SchemaLedger(spark, f"{root}/schema")
    clean_shop_table(spark, lake, "orders", first, turn - timedelta(days=1), {"orders": old}, ledger=ledger)
    clean_shop_table(spark, lake, "orders", turn, last, {"orders": new}, ledger=ledger)
    return read_silver(spark, lake.silver_path("orders"), ledger.versions()[-1])


def dense_rank_every_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank of every part by what its lines cost, in cents."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    lines = _table(spark, sf_dir, "lineitem").select("l_partkey", cents.alias("cents"))
    return dense_ranks(totals(lines, ["l_partkey"], ["cents"]), "cents", "cost_rank")


def dedupe_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents but for their ids, each once."""
    return distinct_rows(spark, f"{sf_dir}/documents.parquet", ["text", "lang", "source", "n_chars"])


def published_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dimension without products of no department, published by switch; then a load that its check refuses; then the whole."""
    root = scratch_dir(spark, "versions")
    database = root.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    products, view = gold_dim_products(spark, sf_dir), f"{database}.dim_products"
    one_row_a_key = lambda df: check_unique_key(df, ["product_id"])
    publish(products.filter("department IS NOT NULL"), f"{root}/dim_products", view, one_row_a_key)
    try:
        publish(products.union(products), f"{root}/dim_products", view, one_row_a_key)
    except ValueError:
        publish(products, f"{root}/dim_products", view, one_row_a_key)
    return spark.table(view)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the orders fact of the star schema."""
    return gold_fact_orders(spark, "/root/testdata/sf0.001")


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "category_count": category_count,
        "topk_entities_by_links": topk_entities_by_links,
        "topk_entities_by_fanout": topk_entities_by_fanout,
        "top1_category_by_amount": top1_category_by_amount,
        "unreferenced_items": unreferenced_items,
        "dense_rank_top3_ties": dense_rank_top3_ties,
        "active_inactive_counts": active_inactive_counts,
        "top1_per_class_exclusive": top1_per_class_exclusive,
        "top1_per_class_overlap": top1_per_class_overlap,
        "top1_hours_exclusive_minute": top1_hours_exclusive_minute,
        "top1_hours_overlap_second": top1_hours_overlap_second,
        "rental_hours": rental_hours,
        "event_hours_minute": event_hours_minute,
        "event_hours_second": event_hours_second,
        "silver_clean_dedupe": silver_clean_dedupe,
        "dedupe_rows": dedupe_rows,
        "orders_day_slice": orders_day_slice,
        "request_grid": request_parameters,
        "gold_fact_orders": gold_fact_orders,
        "gold_fact_orders_day": gold_fact_orders_day,
        "gold_fact_orders_coarse": gold_fact_orders_coarse,
        "gold_dim_clients": gold_dim_clients,
        "gold_dim_products": gold_dim_products,
        "gold_dim_stores": gold_dim_stores,
        "gold_fact_out_of_stock": gold_fact_out_of_stock,
        "check_not_null": check_not_null_rows,
        "check_unique_key": check_unique_key_rows,
        "check_max_length": check_max_length_rows,
        "bronze_csv_round_trip": bronze_csv_round_trip,
        "bronze_json_round_trip": bronze_json_round_trip,
        "bronze_wrapped_json_round_trip": bronze_wrapped_json_round_trip,
        "feed_csv_landing": feed_csv_landing,
        "bronze_csv_awkward": bronze_csv_awkward,
        "bronze_json_awkward": bronze_json_awkward,
        "silver_shop_orders": silver_shop_orders,
        "run_range_orders": run_range_orders,
        "feed_days_corrected": feed_days_corrected,
        "orders_bronze_to_gold": orders_bronze_to_gold,
        "backfill_feed": backfill_feed,
        "warehouse_out_of_stock": warehouse_out_of_stock,
        "warehouse_dim_products": warehouse_dim_products,
        "silver_append_twice": silver_append_twice,
        "silver_static_overwrite": silver_static_overwrite,
        "silver_snapshot_overwrite": silver_snapshot_overwrite,
        "silver_day_partition": silver_day_partition,
        "stream_ingest_feed": stream_ingest_feed,
        "documents_csv_split": documents_csv_split,
        "feed_one_array": feed_one_array,
        "feed_rewritten_in_place": feed_rewritten_in_place,
        "range_changed_days": range_changed_days,
        "orders_columns_moved": orders_columns_moved,
        "dense_rank_every_part": dense_rank_every_part,
        "dedupe_wide_rows": dedupe_wide_rows,
        "published_dim_products": published_dim_products,
    }


_FEED_SQL = "SELECT CAST(ts AS DATE) AS date, user_id AS product_id FROM events"
_AWKWARD_SQL = """
    SELECT event_id, CASE WHEN event_type = 'view' THEN '' WHEN event_type <> 'click' THEN '  ' || event_type || ' "x", ' END AS text, ts
    FROM events"""
_CLEAN_FEED_SQL = f"SELECT DISTINCT date, product_id FROM ({_FEED_SQL}) WHERE date IS NOT NULL AND product_id IS NOT NULL"
_EXCLUSIVE_SQL = """
    SELECT r_regionkey,
           CASE WHEN r_name ILIKE 'a%' THEN 'starts_with_a' WHEN r_name LIKE '%E%' THEN 'contains_e' END AS class
    FROM region"""
_OVERLAP_SQL = """
    SELECT r_regionkey, 'starts_with_a' AS class FROM region WHERE r_name ILIKE 'a%'
    UNION ALL
    SELECT r_regionkey, 'contains_e' AS class FROM region WHERE r_name LIKE '%E%'"""


def _priority_sql(classes: str) -> str:
    return f"""
        SELECT class, category, total_quantity FROM (
            SELECT class, o_orderpriority AS category, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity,
                   ROW_NUMBER() OVER (PARTITION BY class ORDER BY SUM(CAST(l_quantity AS BIGINT)) DESC, o_orderpriority) AS r
            FROM lineitem
            JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey
            JOIN ({classes}) AS classes ON n_regionkey = r_regionkey AND class IS NOT NULL
            GROUP BY class, o_orderpriority) AS t
        WHERE r = 1"""


def _hours_sql(classes: str, unit: str, per_hour: int) -> str:
    return f"""
        SELECT city_type, name, units / {per_hour}.0::DOUBLE AS total_rental_hours FROM (
            SELECT class AS city_type, p_brand AS name, CAST(SUM({unit}) AS BIGINT) AS units,
                   ROW_NUMBER() OVER (PARTITION BY class ORDER BY SUM({unit}) DESC, p_brand) AS r
            FROM lineitem
            JOIN orders ON l_orderkey = o_orderkey
            JOIN part ON l_partkey = p_partkey
            JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey
            JOIN ({classes}) AS classes ON n_regionkey = r_regionkey AND class IS NOT NULL
            GROUP BY class, p_brand) AS t
        WHERE r = 1"""


_RENTAL_MINUTES = (
    "EXTRACT(day FROM l_shipdate - o_orderdate) * 1440 + EXTRACT(hour FROM l_shipdate - o_orderdate) * 60"
    " + EXTRACT(minute FROM l_shipdate - o_orderdate)"
)
_RENTAL_SECONDS = "date_diff('second', o_orderdate, l_shipdate)"


def own_sql() -> dict[str, str]:
    return {
        "category_count": """
            SELECT n_name AS category, COUNT(*) AS item_cnt
            FROM customer JOIN nation ON c_nationkey = n_nationkey
            GROUP BY n_name""",
        "topk_entities_by_links": """
            SELECT s_suppkey, s_name, COUNT(*) AS link_cnt
            FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN orders ON l_orderkey = o_orderkey
            GROUP BY s_suppkey, s_name ORDER BY link_cnt DESC, s_suppkey LIMIT 10""",
        "topk_entities_by_fanout": """
            SELECT s_suppkey, s_name, COUNT(*) AS link_cnt
            FROM supplier
            JOIN lineitem AS a ON s_suppkey = a.l_suppkey
            JOIN lineitem AS b ON a.l_partkey = b.l_partkey
            JOIN orders ON b.l_orderkey = o_orderkey
            GROUP BY s_suppkey, s_name ORDER BY link_cnt DESC, s_suppkey LIMIT 10""",
        "top1_category_by_amount": """
            SELECT r_name AS name, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
            FROM lineitem
            JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey
            GROUP BY r_name ORDER BY SUM(CAST(l_extendedprice AS DECIMAL(18,2))) DESC, r_name LIMIT 1""",
        "unreferenced_items": """
            SELECT p_name FROM part
            LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 49 AND l_returnflag = 'R') AS l
              ON p_partkey = l_partkey
            WHERE l_partkey IS NULL""",
        "dense_rank_top3_ties": """
            SELECT s_name, item_cnt FROM (
                SELECT l_suppkey, COUNT(*) AS item_cnt, DENSE_RANK() OVER (ORDER BY COUNT(*) DESC) AS r
                FROM lineitem JOIN part ON l_partkey = p_partkey
                WHERE p_type = 'ECONOMY' GROUP BY l_suppkey) AS t
            JOIN supplier ON l_suppkey = s_suppkey
            WHERE r < 4""",
        "active_inactive_counts": """
            SELECT n_name AS city,
                   CAST(SUM(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END) AS BIGINT) AS active_customers,
                   CAST(SUM(CASE WHEN c_acctbal >= 0 THEN 0 ELSE 1 END) AS BIGINT) AS not_active_customers
            FROM customer JOIN nation ON c_nationkey = n_nationkey
            GROUP BY n_name""",
        "top1_per_class_exclusive": _priority_sql(_EXCLUSIVE_SQL),
        "top1_per_class_overlap": _priority_sql(_OVERLAP_SQL),
        "top1_hours_exclusive_minute": _hours_sql(_EXCLUSIVE_SQL, _RENTAL_MINUTES, 60),
        "top1_hours_overlap_second": _hours_sql(_OVERLAP_SQL, _RENTAL_SECONDS, 3600),
        "rental_hours": f"""
            SELECT o_orderkey, CAST(SUM({_RENTAL_SECONDS}) AS BIGINT) / 3600.0::DOUBLE AS total_rental_hours
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            GROUP BY o_orderkey""",
        "event_hours_minute": """
            SELECT event_type,
                   CAST(SUM(EXTRACT(hour FROM ts) * 60 + EXTRACT(minute FROM ts)) AS BIGINT) / 60.0::DOUBLE
                     AS total_rental_hours
            FROM events GROUP BY event_type""",
        "event_hours_second": """
            SELECT event_type,
                   CAST(SUM(date_diff('second', date_trunc('day', ts), ts)) AS BIGINT) / 3600.0::DOUBLE
                     AS total_rental_hours
            FROM events GROUP BY event_type""",
        "silver_clean_dedupe": _CLEAN_FEED_SQL,
        "dedupe_rows": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
        "orders_day_slice": "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-03'",
        "request_grid": """
            SELECT date, event_type, CAST(date AS VARCHAR) AS folder,
                   CAST(date AS VARCHAR) || '+' || event_type AS file_name
            FROM (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events) AS d
            CROSS JOIN (SELECT DISTINCT event_type FROM events) AS t""",
        "gold_fact_orders": """
            SELECT CAST(o_orderdate AS DATE) AS order_date, o_custkey AS client_id, l_partkey AS product_id,
                   l_suppkey AS store_id, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            GROUP BY ALL""",
        "gold_fact_orders_day": """
            SELECT CAST(o_orderdate AS DATE) AS order_date, o_custkey AS client_id, l_partkey AS product_id,
                   l_suppkey AS store_id, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-03'
            GROUP BY ALL""",
        "gold_fact_orders_coarse": """
            SELECT CAST(o_orderdate AS DATE) AS order_date, c_nationkey AS client_id, p_size AS product_id,
                   s_nationkey AS store_id, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
                   COUNT(*) AS row_cnt
            FROM lineitem
            JOIN orders ON l_orderkey = o_orderkey
            JOIN part ON l_partkey = p_partkey
            JOIN supplier ON l_suppkey = s_suppkey
            JOIN customer ON o_custkey = c_custkey
            GROUP BY ALL""",
        "gold_dim_clients": """
            SELECT c_custkey AS id, c_name AS fullname, r_name AS area
            FROM customer
            LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20
            LEFT JOIN region ON n_regionkey = r_regionkey""",
        "gold_dim_products": """
            SELECT p_partkey AS product_id, p_name AS product_name, d.p_type AS department, a.p_brand AS aisle
            FROM part AS p
            LEFT JOIN (SELECT DISTINCT p_type FROM part WHERE p_type <> 'SMALL') AS d ON p.p_type = d.p_type
            LEFT JOIN (SELECT DISTINCT p_brand FROM part) AS a ON p.p_brand = a.p_brand""",
        "gold_dim_stores": """
            SELECT s_suppkey AS store_id, n_name AS type, r_name AS area
            FROM supplier
            LEFT JOIN nation ON s_nationkey = n_nationkey
            LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey < 3""",
        "gold_fact_out_of_stock": f"SELECT date, product_id FROM ({_CLEAN_FEED_SQL}) WHERE date = DATE '2024-01-05'",
        "check_not_null": """
            SELECT 'n_name' AS column_name, COUNT(*) AS violations
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20
            WHERE n_name IS NULL""",
        "check_unique_key": """
            SELECT l_orderkey, l_linenumber, COUNT(*) AS row_cnt
            FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
        "check_max_length": "SELECT p_partkey, p_name FROM part WHERE LENGTH(p_name) > 10",
        "bronze_csv_round_trip": "SELECT * FROM customer",
        "bronze_json_round_trip": _FEED_SQL,
        "bronze_wrapped_json_round_trip": _FEED_SQL,
        "feed_csv_landing": _FEED_SQL,
        "bronze_csv_awkward": _AWKWARD_SQL,
        "bronze_json_awkward": _AWKWARD_SQL,
        "silver_shop_orders": """
            SELECT DISTINCT user_id % 50 AS product_id, user_id AS client_id, CAST(length(event_type) AS BIGINT) AS store_id,
                   event_id % 100 AS quantity, CAST(ts AS DATE) AS order_date
            FROM events""",
        "run_range_orders": """
            SELECT order_date, CAST(client_id AS INTEGER) AS client_id, CAST(product_id AS INTEGER) AS product_id,
                   CAST(store_id AS INTEGER) AS store_id, CAST(SUM(quantity) AS INTEGER) AS quantity
            FROM (SELECT DISTINCT user_id % 50 AS product_id, user_id AS client_id, length(event_type) AS store_id,
                         event_id % 100 AS quantity, CAST(ts AS DATE) AS order_date
                  FROM events) AS o
            GROUP BY ALL""",
        "feed_days_corrected": """
            SELECT DISTINCT date, product_id, layer
            FROM (SELECT CAST(ts AS DATE) AS date, user_id AS product_id FROM events) AS e
            CROSS JOIN (VALUES ('silver'), ('gold')) AS l(layer)
            WHERE date NOT IN (SELECT CAST(MIN(ts) AS DATE) + n FROM events CROSS JOIN (VALUES (1), (2)) AS v(n) GROUP BY n)""",
        "orders_bronze_to_gold": """
            SELECT order_date, client_id, product_id, store_id, CAST(SUM(quantity) AS BIGINT) AS quantity FROM (
                SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_date, o_custkey AS client_id,
                       l_partkey AS product_id, l_suppkey AS store_id, CAST(l_quantity AS BIGINT) AS quantity
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS o
            GROUP BY ALL""",
        "backfill_feed": _CLEAN_FEED_SQL,
        "warehouse_out_of_stock": f"""
            SELECT date, CAST(product_id AS INTEGER) AS product_id FROM ({_CLEAN_FEED_SQL})""",
        "warehouse_dim_products": """
            SELECT CAST(p_partkey AS INTEGER) AS product_id, p_name AS product_name, d.p_type AS department,
                   a.p_brand AS aisle
            FROM part AS p
            LEFT JOIN (SELECT DISTINCT p_type FROM part WHERE p_type <> 'SMALL') AS d ON p.p_type = d.p_type
            LEFT JOIN (SELECT DISTINCT p_brand FROM part) AS a ON p.p_brand = a.p_brand""",
        "silver_append_twice": _CLEAN_FEED_SQL,
        "silver_static_overwrite": f"SELECT date, product_id FROM ({_CLEAN_FEED_SQL}) WHERE date >= DATE '2024-01-15'",
        "silver_snapshot_overwrite": """
            SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders""",
        "silver_day_partition": f"SELECT date, product_id FROM ({_CLEAN_FEED_SQL}) WHERE date = DATE '2024-01-05'",
        "stream_ingest_feed": _CLEAN_FEED_SQL,
        "documents_csv_split": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "feed_one_array": _CLEAN_FEED_SQL,
        "feed_rewritten_in_place": """
            SELECT DISTINCT CAST(ts AS DATE) AS date, user_id AS product_id
            FROM events, (SELECT CAST(MIN(ts) AS DATE) AS first FROM events) AS f
            WHERE CAST(ts AS DATE) <> first + 2 AND (CAST(ts AS DATE) <> first + 1 OR event_type <> 'view')""",
        "dense_rank_every_part": """
            SELECT l_partkey, cents, DENSE_RANK() OVER (ORDER BY cents DESC) AS cost_rank
            FROM (SELECT l_partkey, CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY l_partkey) AS t""",
        "dedupe_wide_rows": "SELECT DISTINCT text, lang, source, n_chars FROM documents",
        "published_dim_products": """
            SELECT p_partkey AS product_id, p_name AS product_name, d.p_type AS department, a.p_brand AS aisle
            FROM part AS p
            LEFT JOIN (SELECT DISTINCT p_type FROM part WHERE p_type <> 'SMALL') AS d ON p.p_type = d.p_type
            LEFT JOIN (SELECT DISTINCT p_brand FROM part) AS a ON p.p_brand = a.p_brand""",
        "orders_columns_moved": """
            SELECT DISTINCT user_id % 50 AS product_id, user_id AS client_id, CAST(length(event_type) AS BIGINT) AS store_id,
                   event_id % 100 + CASE WHEN CAST(ts AS DATE) < first + 10 THEN 0 ELSE 1099511627776 END AS quantity, CAST(ts AS DATE) AS order_date,
                   CASE WHEN CAST(ts AS DATE) >= first + 10 THEN 'c' || length(event_type) END AS channel
            FROM events, (SELECT CAST(MIN(ts) AS DATE) AS first FROM events) AS f""",
        "range_changed_days": """
            SELECT order_date, CAST(client_id AS INTEGER) AS client_id, CAST(product_id AS INTEGER) AS product_id,
                   CAST(store_id AS INTEGER) AS store_id, CAST(SUM(quantity) AS INTEGER) AS quantity, MIN(times_written) AS times_written
            FROM (SELECT DISTINCT user_id % 50 AS product_id, user_id AS client_id, length(event_type) AS store_id,
                         event_id % 100 + CASE WHEN CAST(ts AS DATE) = first + 1 THEN 1000 ELSE 0 END AS quantity, CAST(ts AS DATE) AS order_date,
                         CAST(CASE WHEN CAST(ts AS DATE) = first + 1 THEN 2 ELSE 1 END AS BIGINT) AS times_written
                  FROM events, (SELECT CAST(MIN(ts) AS DATE) AS first FROM events) AS f) AS o
            GROUP BY order_date, client_id, product_id, store_id""",
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return own_queries() | (llm_queries.queries() if llm_queries else {})


def oracle_sql() -> dict[str, str]:
    return own_sql() | (llm_queries.oracle_sql() if llm_queries else {})
