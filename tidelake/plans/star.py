"""Gold tables from silver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidelake.operators.rollup import totals
from tidelake.operators.skew import lookup_join
from tidelake.sources.files import day_slice


def fact_orders(orders: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Quantity per day, client, product and store; of some days if given."""
    rows = day_slice(orders, "order_date", start, end) if start else orders
    return totals(rows, ["order_date", "client_id", "product_id", "store_id"], "quantity")


def fact_out_of_stock(out_of_stock: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """The products out of stock per day; of some days if given."""
    rows = day_slice(out_of_stock, "date", start, end) if start else out_of_stock
    return rows.select("date", "product_id")


def dim_products(products: DataFrame, departments: DataFrame, aisles: DataFrame) -> DataFrame:
    """Products with their department and aisle, null where there is none."""
    joined = lookup_join(products, departments.select("department_id", "department"), "department_id", "left")
    joined = lookup_join(joined, aisles.select("aisle_id", "aisle"), "aisle_id", "left", keys_from=products)
    return joined.select("product_id", "product_name", "department", "aisle")


def _areas(location_areas: DataFrame) -> DataFrame:
    return location_areas.select(F.col("area_id").alias("location_area_id"), "area")


def dim_stores(stores: DataFrame, store_types: DataFrame, location_areas: DataFrame) -> DataFrame:
    """Stores with their type and area, null where there is none."""
    joined = lookup_join(stores, store_types.select("store_type_id", "type"), "store_type_id", "left")
    joined = lookup_join(joined, _areas(location_areas), "location_area_id", "left", keys_from=stores)
    return joined.select("store_id", "type", "area")


def dim_clients(clients: DataFrame, location_areas: DataFrame) -> DataFrame:
    """Clients with their area, null where there is none."""
    return lookup_join(clients, _areas(location_areas), "location_area_id", "left").select("id", "fullname", "area")
