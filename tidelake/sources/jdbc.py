"""Relational tables over JDBC, read by many tasks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidelake.sources.files import day_slice

# Fixed value: tables of which only the day's rows are extracted, with their date column.
SLICED_BY_DAY = {"orders": "order_date"}
#: Rows that a task reads where the number of tasks follows the table's size.
ROWS_PER_TASK = 1_000_000


def _jdbc(spark: SparkSession, url: str, properties: Mapping[str, str], **options) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, **options, **properties).load()


def jdbc_bounds(
    spark: SparkSession, url: str, table: str, column: str, properties: Mapping[str, str]
) -> tuple[str, str] | None:
    """Lowest and highest value of ``column``, computed by the database; nothing if there is none."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    lowest, highest = _jdbc(spark, url, properties, query=query).first()
    return None if lowest is None else (str(lowest), str(highest))


def spread(
    spark: SparkSession, url: str, table: str, columns: Sequence[str], properties: Mapping[str, str], rows_per_task: int
) -> list[str] | None:
    """Conditions that deal a table's rows to tasks of about ``rows_per_task`` rows each; nothing if one task is enough.

    Rows are dealt by a sum over several integer ``columns``, so that a value that many rows share in one of them is spread by the others. Nulls
    count as zero; every row meets one condition.
    """
    query = f"SELECT COUNT(*) AS n FROM {table}"
    tasks = -(-int(_jdbc(spark, url, properties, query=query).first()[0]) // rows_per_task)
    # Remainders by primes, so that sums neither overflow nor follow a pattern of the keys.
    total = " + ".join(f"MOD(COALESCE(CAST({c} AS BIGINT), 0), 1000003) * {7919 * (n + 1)}" for n, c in enumerate(columns))
    return [f"MOD(MOD(ABS({total}), 999983), {tasks}) = {k}" for k in range(tasks)] if tasks > 1 else None


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    num_partitions: int = 1,
    bounds: tuple | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int = 10_000,
    spread_by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """A table, read by one task unless told how to split it.

    With ``spread_by``, integer columns, the database counts the rows, and as many tasks read it as have ``rows_per_task`` rows each.

    Either an integer, date or timestamp ``partition_column`` is cut into
    ``num_partitions`` strides between ``bounds`` (asked from the database if not given),
    or, where its values are unevenly spread, ``predicates`` lists one condition per
    task. Filters and columns chosen later reach the database.
    """
    if spread_by and predicates is None:
        predicates = spread(spark, url, table, spread_by, properties, rows_per_task)
    if predicates is not None:
        options = {"fetchsize": str(fetch_size), **properties}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    options = {"dbtable": table, "fetchsize": fetch_size}
    if partition_column is not None:
        bounds = bounds or jdbc_bounds(spark, url, table, partition_column, properties)
        if bounds is not None:
            options |= {
                "partitionColumn": partition_column,
                "lowerBound": str(bounds[0]),
                "upperBound": str(bounds[1]),
                "numPartitions": num_partitions,
            }
    return _jdbc(spark, url, properties, **options)


def list_tables(spark: SparkSession, url: str, properties: Mapping, schema: str = "public") -> DataFrame:
    """Names of all tables in one schema of the database."""
    name = schema.replace("'", "''")
    query = f"SELECT table_name FROM information_schema.tables WHERE table_schema = '{name}'"
    return _jdbc(spark, url, properties, query=query)


def extract_table(
    spark: SparkSession,
    url: str,
    table: str,
    day: date,
    properties: Mapping[str, str],
    sliced: Mapping[str, str] = SLICED_BY_DAY,
    last: date | None = None,
    **read_options,
) -> DataFrame:
    """What one day's run lands of ``table``: the day's rows of a sliced table, or those of the days to ``last``; else all.

    The database makes the slice, so that strides of a ``partition_column`` lie between the bounds of the slice and not of all days.
    """
    name = table.rsplit(".", 1)[-1]
    if name not in sliced:
        return read_table(spark, url, table, properties, **read_options)
    column = sliced[name]
    days = f"= DATE '{day}'" if last in (None, day) else f"BETWEEN DATE '{day}' AND DATE '{last}'"
    rows = read_table(spark, url, f"(SELECT * FROM {table} WHERE {column} {days}) AS day_rows", properties, **read_options)
    return day_slice(rows, column, day, last)
