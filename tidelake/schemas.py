"""Declared schemas of the bronze, silver and gold tables, and their write policies.

Schemas are declared, never inferred: a day whose column is all empty would
otherwise infer another type than the day before and make the table unreadable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


INT, STR, DATE = T.IntegerType(), T.StringType(), T.DateType()

# The columns of the shop database and of the out-of-stock feed.
SHOP_SCHEMAS = {
    "orders": _schema(product_id=INT, client_id=INT, store_id=INT, quantity=INT, order_date=DATE),
    "products": _schema(product_id=INT, product_name=STR, department_id=INT, aisle_id=INT),
    "departments": _schema(department_id=INT, department=STR),
    "aisles": _schema(aisle_id=INT, aisle=STR),
    "stores": _schema(store_id=INT, store_type_id=INT, location_area_id=INT),
    "store_types": _schema(store_type_id=INT, type=STR),
    "location_areas": _schema(area_id=INT, area=STR),
    "clients": _schema(id=INT, fullname=STR, location_area_id=INT),
}
OUT_OF_STOCK_SCHEMA = _schema(date=DATE, product_id=INT)


@dataclass(frozen=True)
class WritePolicy:
    """How a day's rows enter a table.

    ``append`` with a partition column replaces only the partitions present in
    the rows, so running a day twice changes nothing; without one it adds the rows
    as they are. ``overwrite`` replaces the whole table.
    """

    mode: str
    partition_by: str | None = None

    def __post_init__(self):
        if self.mode not in ("append", "overwrite"):
            raise ValueError(f"unknown write mode {self.mode!r}")


# Write mode and partition column per silver table.
WRITE_POLICIES = {
    "orders": WritePolicy("append", "order_date"),
    "aisles": WritePolicy("overwrite"),
    "clients": WritePolicy("overwrite"),
    "departments": WritePolicy("overwrite"),
    "location_areas": WritePolicy("overwrite"),
    "products": WritePolicy("overwrite"),
    "store_types": WritePolicy("overwrite"),
    "stores": WritePolicy("overwrite"),
    "out_of_stock": WritePolicy("append", "date"),
}


def write_policy(table: str, policies: dict[str, WritePolicy] = WRITE_POLICIES) -> WritePolicy:
    """The policy of ``table``; a table without one is an error."""
    if table not in policies:
        raise KeyError(f"no write policy for table {table!r}")
    return policies[table]


@dataclass(frozen=True)
class StarTable:
    """One gold table: columns, and either a unique key or a partition and bucket column."""

    columns: T.StructType
    key: str | None = None
    partition_by: str | None = None
    bucket_by: str | None = None

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.columns if not f.nullable]

    @property
    def max_lengths(self) -> dict[str, int]:
        return {f.name: f.dataType.length for f in self.columns if isinstance(f.dataType, T.VarcharType)}


def _required(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, nullable=False)


def _varchar(name: str, length: int) -> T.StructField:
    return T.StructField(name, T.VarcharType(length))


# The star schema, its keys and column lengths.
STAR_SCHEMA = {
    "orders": StarTable(
        T.StructType([
            _required("order_date", DATE),
            _required("client_id", INT),
            _required("product_id", INT),
            _required("store_id", INT),
            T.StructField("quantity", INT),
        ]),
        partition_by="order_date",
        bucket_by="store_id",
    ),
    "out_of_stock": StarTable(
        T.StructType([_required("date", DATE), _required("product_id", INT)]),
        partition_by="date",
        bucket_by="product_id",
    ),
    "dim_clients": StarTable(
        T.StructType([_required("id", INT), _varchar("fullname", 63), _varchar("area", 64)]),
        key="id",
    ),
    "dim_products": StarTable(
        T.StructType([
            _required("product_id", INT),
            _varchar("product_name", 255),
            _varchar("department", 127),
            _varchar("aisle", 127),
        ]),
        key="product_id",
    ),
    "dim_stores": StarTable(
        T.StructType([_required("store_id", INT), _varchar("type", 64), _varchar("area", 64)]),
        key="store_id",
    ),
}
