"""Daily landing files (bronze) and Parquet tables (silver)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidelake.sources import split

# PostgreSQL writes a quote inside a quoted field twice.
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"'}
# A field without anything is null; a quoted empty one is an empty text. The reader tells them
# apart only where its null marker is not empty.
CSV_READ = CSV_DIALECT | {"nullValue": "\u0001", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def date_range(start: date, end: date) -> list[date]:
    """The days from ``start`` to ``end``, both included."""
    return [start + timedelta(days=n) for n in range((end - start).days + 1)]


# Where a day's landing lies below its source: one file or folder named after the day,
# or, where one job lands many days, a folder per value of a partition column.
DAY_FILES = "{day}.{extension}"
DAY_FOLDERS = "as_of_date={day}"


def bronze_path(root: str, source: str, day: date, extension: str, layout: str = DAY_FILES) -> str:
    """Where the landing of ``source`` (``<db>/<table>`` or a feed) for one day lies."""
    return f"{root.rstrip('/')}/{source}/{layout.format(day=day.isoformat(), extension=extension)}"


def bronze_paths(
    root: str, source: str, start: date, end: date, extension: str, layout: str = DAY_FILES
) -> list[str]:
    return [bronze_path(root, source, day, extension, layout) for day in date_range(start, end)]


def file_day(path: Column, layout: str) -> Column:
    """The day that a landing file's own name, or its folder's, gives; null if it gives none."""
    name = re.escape(layout).replace(r"\{day\}", r"(\d{4}-\d{2}-\d{2})").replace(r"\{extension\}", r"\w+")
    day = F.regexp_extract(path, f".*/{name}(/.*)?$", 1)
    return F.when(day != "", day).cast("date")


def read_bronze_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    multiline: bool = False,
    file_column: str | None = None,
    block_bytes: int | None = None,
) -> DataFrame:
    """CSV with a header and a declared schema; a malformed record or other header is an error.

    Files are split over tasks. With ``multiline`` a field may hold line breaks: a file is then read in blocks, of ``block_bytes`` if given,
    whose open quotes are counted first. A field without anything is null, a
    quoted empty one an empty text. Booleans may be written ``t`` and ``f``. ``file_column`` adds the path of each row's file.
    """
    flags = [f.name for f in schema if isinstance(f.dataType, T.BooleanType)]
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in flags else f.dataType) for f in schema]
    )
    if multiline:
        rows = split.read_csv(spark, paths, as_text, CSV_READ, "_path" if file_column else None, block_bytes)
        path = [F.col("_path").alias(file_column)] if file_column else []
    else:
        rows = spark.read.schema(as_text).options(**CSV_READ, enforceSchema=False, mode="FAILFAST").csv(paths)
        path = _path(file_column)
    columns = [F.col(f.name).cast("boolean") if f.name in flags else F.col(f.name) for f in schema]
    return rows.select(*columns, *path)


def read_bronze_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    wrapped: bool = False,
    multiline: bool = False,
    file_column: str | None = None,
    block_bytes: int | None = None,
) -> DataFrame:
    """JSON arrays of objects, one row per element; ``wrapped`` reads ``{"data": [...]}``.

    A value that does not fit ``schema`` becomes null. One small array per line lets files be split by lines. ``multiline`` reads files that are one array
    each, on one line or many, in blocks, of ``block_bytes`` if given, whose strings and braces are counted first. ``file_column`` adds the path of each row's file.
    """
    if multiline:
        return split.read_json(spark, paths, schema, wrapped, file_column, block_bytes)
    declared = T.StructType([T.StructField("data", T.ArrayType(schema))]) if wrapped else schema
    rows = spark.read.schema(declared).json(paths)
    if wrapped:
        return rows.select(*_path(file_column), F.inline("data")).select(*schema.fieldNames(), *([file_column] if file_column else []))
    return rows.select(*schema.fieldNames(), *_path(file_column))


def _path(name: str | None) -> list[Column]:
    return [F.col("_metadata.file_path").alias(name)] if name else []


def day_slice(df: DataFrame, column: str, start: date, end: date | None = None) -> DataFrame:
    """Rows of one day, or of the days ``start`` to ``end``.

    The bounds are literals of the column's own type, so the filter prunes
    partitions or reaches the Parquet or JDBC scan; a cast of the column would not.
    """
    last = end or start
    dtype = df.schema[column].dataType
    lower = F.lit(start.isoformat()).cast(dtype)
    if isinstance(dtype, T.DateType):
        return df.filter(F.col(column).between(lower, F.lit(last.isoformat()).cast(dtype)))
    after = F.lit((last + timedelta(days=1)).isoformat()).cast(dtype)
    return df.filter((F.col(column) >= lower) & (F.col(column) < after))


def read_silver(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    date_column: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """A silver table, or only the partitions of some days; the partition column stays."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(path)
    return day_slice(rows, date_column, start, end) if date_column and start else rows
