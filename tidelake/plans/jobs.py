"""Daily and ranged loads from the shop database over bronze and silver to gold.

A range of days is one extract of each table and one Spark job per table and layer, not one per day. Every job
can be run again: it replaces the days, or the snapshot, that it writes.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidelake.operators.quality import clean
from tidelake.plans import star
from tidelake.schemas import OUT_OF_STOCK_SCHEMA, SHOP_SCHEMAS, WRITE_POLICIES, WritePolicy, write_policy
from tidelake.session import staged
from tidelake.sinks.files import FILE_DAY, days_of, observed, replace_days, write_csv, write_table
from tidelake.sinks.jdbc import write_jdbc
from tidelake.sinks.warehouse import load_dimension, load_fact
from tidelake.sources.evolving import SchemaLedger, read_evolving_csv
from tidelake.sources.files import DAY_FILES, DAY_FOLDERS, bronze_paths, date_range, file_day, read_bronze_csv, read_bronze_json, read_silver
from tidelake.sources.jdbc import SLICED_BY_DAY, extract_table, list_tables


@dataclass(frozen=True)
class Lake:
    """Where the layers lie, and what they hold."""

    bronze: str
    silver: str
    gold_database: str = "gold"
    source: str = "shop"
    feed: str = "out_of_stock"
    bronze_layout: str = DAY_FILES

    def bronze_paths(self, source: str, start: date, end: date, extension: str) -> list[str]:
        return bronze_paths(self.bronze, source, start, end, extension, self.bronze_layout)

    def silver_path(self, table: str) -> str:
        folder = self.feed if table == "out_of_stock" else f"{self.source}/{table}"
        return f"{self.silver.rstrip('/')}/{folder}"


def _together(spark: SparkSession, jobs: list[Callable[[], object]], at_once: int) -> list:
    """Results of independent jobs, submitted side by side so that small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in running]


def _split(table: str, schemas: Mapping[str, T.StructType]) -> dict:
    """How to read a table if nothing is said: by as many tasks as its rows ask for, dealt by all its integer columns together."""
    keys = [f.name for f in schemas.get(table, ()) if isinstance(f.dataType, (T.IntegerType, T.LongType))]
    return {"spread_by": keys} if keys else {}


def land_shop_table(
    spark: SparkSession,
    lake: Lake,
    url: str,
    properties: Mapping[str, str],
    table: str,
    day: date,
    schema: str = "public",
    **read_options,
) -> None:
    """One table of the database to bronze CSV: the day's orders, other tables whole.

    ``read_options`` split the read over tasks, each of which lands a file; without any, a declared table is
    read by as many tasks as its rows ask for.
    """
    rows = extract_table(spark, url, f"{schema}.{table}", day, properties, **(read_options or _split(table, SHOP_SCHEMAS)))
    [path] = lake.bronze_paths(f"{lake.source}/{table}", day, day, "csv")
    write_csv(rows, path)


def land_shop(
    spark: SparkSession,
    lake: Lake,
    url: str,
    properties: Mapping[str, str],
    day: date,
    schema: str = "public",
    read_options: Mapping[str, dict] | None = None,
    at_once: int = 4,
) -> list[str]:
    """Every table the database lists to bronze CSV; returns their names."""
    names = [row[0] for row in list_tables(spark, url, properties, schema).collect()]
    options = {name: (read_options or {}).get(name, {}) for name in names}
    land = partial(land_shop_table, spark, lake, url, properties)
    _together(spark, [partial(land, name, day, schema, **options[name]) for name in names], at_once)
    return names


def land_shop_range(
    spark: SparkSession,
    lake: Lake,
    url: str,
    properties: Mapping[str, str],
    start: date,
    end: date,
    schema: str = "public",
    read_options: Mapping[str, dict] | None = None,
    at_once: int = 4,
) -> list[str]:
    """Every table the database lists to bronze CSV for the days ``start`` to ``end``, each extracted once; returns their names.

    Of a table sliced by day all days' rows are extracted together and landed by day, a day without rows as a file without rows. Other tables land whole, on the
    last day: the day that silver reads them of.
    """
    names = [row[0] for row in list_tables(spark, url, properties, schema).collect()]

    def land(name: str) -> None:
        options = (read_options or {}).get(name) or _split(name, SHOP_SCHEMAS)
        rows = extract_table(spark, url, f"{schema}.{name}", start, properties, last=end, **options)
        if name not in SLICED_BY_DAY:
            write_csv(rows, *lake.bronze_paths(f"{lake.source}/{name}", end, end, "csv"))
            return
        # Read by the database once, and by day from there.
        column, rows = SLICED_BY_DAY[name], staged(rows, "extract")
        days = date_range(start, end)
        if lake.bronze_layout == DAY_FOLDERS:
            write_csv(rows, f"{lake.bronze.rstrip('/')}/{lake.source}/{name}", day_column=column)
            days = sorted(set(days) - set(days_of(rows, column)["days"]))
        for day in days:
            write_csv(rows.filter(F.col(column) == F.lit(day)), *lake.bronze_paths(f"{lake.source}/{name}", day, day, "csv"))

    _together(spark, [partial(land, name) for name in names], at_once)
    return names


def _own_days(rows: DataFrame, column: str, path_column: str, layout: str) -> DataFrame:
    """A row of another day than its file's fails the write, as it would replace that day's partition.

    So a range of days accepts what its days accept one by one. Rows without a day pass; cleaning drops them or not.
    """
    day = file_day(F.col(path_column), layout)
    told = F.concat(F.lit(f"{column} "), F.col(column).cast("string"), F.lit(" in the file of "), F.coalesce(day.cast("string"), F.col(path_column)))
    stray = F.col(column).isNotNull() & ~F.col(column).eqNullSafe(day)
    checked = F.when(stray, F.raise_error(told).cast("date")).otherwise(F.col(column))
    return rows.withColumn(column, checked).drop(path_column)


def clean_shop_table(
    spark: SparkSession,
    lake: Lake,
    table: str,
    start: date,
    end: date | None = None,
    schemas: Mapping[str, T.StructType] = SHOP_SCHEMAS,
    policies: dict[str, WritePolicy] = WRITE_POLICIES,
    dedupe: bool = True,
    multiline: bool = False,
    ledger: SchemaLedger | None = None,
) -> None:
    """Bronze CSV of a table to silver, full rows once.

    With a ``ledger`` files may name the table's columns in any order and lack some: the table then has all columns that were ever declared, in
    their widest types, and days written before read as nulls what they lack. A declaration that narrows a column is an error before anything is read.

    Of a table that each day replaces as a whole, only the last day is read. Of one by day, a day without rows becomes empty. Rows
    without a day stay, in the partition of null, and are replaced with the day of their file.
    """
    policy = write_policy(table, policies)
    source, last = f"{lake.source}/{table}", end or start
    if policy.mode == "overwrite":
        start = last
    paths = lake.bronze_paths(source, start, last, "csv")
    schema = schemas[table] if ledger is None else ledger.declare(schemas[table])
    read = read_bronze_csv if ledger is None else read_evolving_csv
    if not policy.partition_by:
        rows = clean(read(spark, paths, schema, multiline), dedupe=dedupe)
        write_table(rows, lake.silver_path(table), policy, gather=last > start)
        return
    rows = read(spark, paths, schema, multiline, file_column="_file")
    if policy.mode == "append":
        rows = rows.withColumn(FILE_DAY, F.when(F.col(policy.partition_by).isNull(), file_day(F.col("_file"), lake.bronze_layout)))
    rows = clean(_own_days(rows, policy.partition_by, "_file", lake.bronze_layout), dedupe=dedupe)
    _write_days(rows, lake.silver_path(table), policy, start, last)


def _write_days(rows: DataFrame, path: str, policy: WritePolicy, start: date, last: date) -> None:
    if policy.mode == "append":
        replace_days(rows, path, policy, start, last)
    else:
        write_table(rows, path, policy, gather=last > start)


def clean_out_of_stock(
    spark: SparkSession,
    lake: Lake,
    start: date,
    end: date | None = None,
    schema: T.StructType = OUT_OF_STOCK_SCHEMA,
    policies: dict[str, WritePolicy] = WRITE_POLICIES,
    one_array: bool = False,
) -> dict[str, int]:
    """Bronze JSON of the feed to silver; returns how many rows were read and dropped for nulls.

    With ``one_array`` a day's file, one array of all its rows on one line or many, is read by many tasks. A day whose file holds no rows, or an error message instead, becomes an empty day.
    """
    last = end or start
    paths = lake.bronze_paths(lake.feed, start, last, "json")
    counts, policy = Observation(), write_policy("out_of_stock", policies)
    read = read_bronze_json(spark, paths, schema, multiline=one_array, file_column="_file")
    read = _own_days(read, policy.partition_by, "_file", lake.bronze_layout)
    needed = ["date", "product_id"]
    _write_days(clean(read, needed, observation=counts), lake.silver_path("out_of_stock"), policy, start, last)

    def again() -> dict:
        null = F.col(needed[0]).isNull() | F.col(needed[1]).isNull()
        return read.agg(F.count("*").alias("rows_read"), F.count_if(null).alias("rows_dropped_null")).first().asDict()

    return observed(counts, again)


GOLD_FACTS = ("orders", "out_of_stock")
GOLD_DIMENSIONS = ("dim_clients", "dim_products", "dim_stores")


SILVER_SCHEMAS = SHOP_SCHEMAS | {"out_of_stock": OUT_OF_STOCK_SCHEMA}


def gold_rows(
    spark: SparkSession,
    lake: Lake,
    table: str,
    start: date,
    end: date | None = None,
    schemas: Mapping[str, T.StructType] = SILVER_SCHEMAS,
) -> DataFrame:
    """Rows of one gold table from silver: the days of a fact, the whole of a dimension."""

    def silver(name: str) -> DataFrame:
        # Declared, as a table whose days are all empty has no file to infer from.
        return read_silver(spark, lake.silver_path(name), schemas[name])

    if table == "orders":
        return star.fact_orders(silver("orders"), start, end)
    if table == "out_of_stock":
        return star.fact_out_of_stock(silver("out_of_stock"), start, end)
    if table == "dim_clients":
        return star.dim_clients(silver("clients"), silver("location_areas"))
    if table == "dim_products":
        return star.dim_products(silver("products"), silver("departments"), silver("aisles"))
    if table == "dim_stores":
        return star.dim_stores(silver("stores"), silver("store_types"), silver("location_areas"))
    raise KeyError(f"no load for gold table {table!r}")


def load_gold(
    spark: SparkSession,
    lake: Lake,
    table: str,
    start: date,
    end: date | None = None,
    schemas: Mapping[str, T.StructType] = SILVER_SCHEMAS,
) -> None:
    """One gold table into the Spark warehouse; a fact's days without rows become empty."""
    rows = gold_rows(spark, lake, table, start, end, schemas)
    if table in GOLD_FACTS:
        load_fact(rows, lake.gold_database, table, start=start, end=end)
    else:
        load_dimension(rows, lake.gold_database, table)


def load_gold_jdbc(
    spark: SparkSession,
    lake: Lake,
    url: str,
    properties: Mapping[str, str],
    table: str,
    start: date,
    end: date | None = None,
    schema: str = "public",
) -> None:
    """One gold table into a JDBC warehouse: facts are appended, dimensions replaced."""
    mode = "append" if table in GOLD_FACTS else "overwrite"
    write_jdbc(gold_rows(spark, lake, table, start, end), url, f"{schema}.{table}", properties, mode)


@dataclass(frozen=True)
class ShopDatabase:
    """Where a run lands its tables from, and how each is split over tasks."""

    url: str
    properties: Mapping[str, str]
    schema: str = "public"
    read_options: Mapping[str, dict] = field(default_factory=dict)


def run_range(
    spark: SparkSession,
    lake: Lake,
    start: date,
    end: date | None = None,
    at_once: int = 4,
    database: ShopDatabase | None = None,
    tables: Sequence[str] | None = None,
    schemas: Mapping[str, T.StructType] = SILVER_SCHEMAS,
    policies: dict[str, WritePolicy] = WRITE_POLICIES,
    gold_tables: Sequence[str] = GOLD_FACTS + GOLD_DIMENSIONS,
    multiline: Collection[str] = (),
    dedupe: bool = True,
    one_array: bool = False,
) -> dict[str, int]:
    """Bronze of the shop, then all silver tables, then the gold tables, for the days ``start`` to ``end``.

    With a ``database`` every table it lists is extracted once for all days, and taken to silver; without one, bronze has landed before, and
    ``tables`` (all with a schema) are taken. A table without a write policy or a schema is an error before silver begins. Tables
    in ``multiline`` hold line breaks in their fields; ``one_array``: the feed's files are an array each. The feed's bronze is landed by whoever asks for it. Any failure stops the run
    after its layer, so gold never follows a failed silver. Returns how many rows of the feed were read and dropped.
    """
    if database is not None:
        listed = land_shop_range(spark, lake, database.url, database.properties, start, end or start, database.schema, database.read_options, at_once)
        tables = listed if tables is None else tables
    tables = [t for t in schemas if t != "out_of_stock"] if tables is None else tables
    for table in tables:
        write_policy(table, policies)
        if table not in schemas:
            raise KeyError(f"no schema for table {table!r}")
    shop = [
        partial(clean_shop_table, spark, lake, table, start, end, schemas, policies, dedupe, table in multiline) for table in tables
    ]
    feed = partial(clean_out_of_stock, spark, lake, start, end, schemas["out_of_stock"], policies, one_array)
    counts, *_ = _together(spark, [feed, *shop], at_once)
    _together(spark, [partial(load_gold, spark, lake, table, start, end, schemas) for table in gold_tables], at_once)
    return counts
