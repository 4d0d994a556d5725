"""The star schema as Spark tables: DDL, constraint checks and loads."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidelake.operators.quality import check_unique_key
from tidelake.schemas import STAR_SCHEMA, StarTable
from tidelake.session import staged
from tidelake.sinks.files import days_of, gathered, observed

BUCKET_COUNT_PROPERTY = "star.buckets"
# A day's bucket is a file; this is a size that is read well.
BUCKET_BYTES = 128 * 1024 * 1024


def _table_ddl(name: str, table: StarTable, buckets: int) -> str:
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in table.columns
    )
    options = {"compression": "zstd"}
    if table.partition_by:
        # As an option of the table, because insertInto ignores it as one of the writer.
        options["partitionOverwriteMode"] = "dynamic"
    listed = ", ".join(f"{key} '{value}'" for key, value in options.items())
    ddl = f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS ({listed})"
    if table.partition_by:
        ddl += f" PARTITIONED BY (`{table.partition_by}`)"
    if table.bucket_by:
        ddl += f" CLUSTERED BY (`{table.bucket_by}`) INTO {buckets} BUCKETS"
        ddl += f" TBLPROPERTIES ('{BUCKET_COUNT_PROPERTY}' = '{buckets}')"
    return ddl


def create_star_schema(
    spark: SparkSession,
    database: str,
    location: str | None = None,
    buckets: int = 64,
    tables: dict[str, StarTable] = STAR_SCHEMA,
    day_bytes: Mapping[str, int] | None = None,
) -> None:
    """Drop the gold tables with their rows, and create them.

    ``day_bytes`` says how large a day of a fact is; it then has a bucket for every ``BUCKET_BYTES`` of it, instead of ``buckets``.

    A new database keeps its tables at ``location``, or in the session's warehouse. Facts are partitioned by date and bucketed by the column they are mostly
    grouped by, which then needs no shuffle. Text columns keep their VARCHAR length,
    which Spark enforces on write.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for name, table in tables.items():
        # Managed tables, as dropping one that only points to its files would leave the rows there.
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        size = (day_bytes or {}).get(name)
        count = buckets if size is None else max(1, -(-size // BUCKET_BYTES))
        spark.sql(_table_ddl(f"{database}.{name}", table, count))


def find_violations(df: DataFrame, table: StarTable) -> DataFrame:
    """Broken constraints of ``table`` in ``df`` as (check, column_name, violations).

    One pass for nulls and lengths, a grouping for the key.
    """
    broken = {("not_null", name): F.col(name).isNull() for name in table.required}
    broken |= {("max_length", name): F.length(name) > limit for name, limit in table.max_lengths.items()}
    counts = df.agg(*[F.count_if(rule).alias("_".join(names)) for names, rule in broken.items()])
    found = counts.select(
        F.inline(
            F.array(*[
                F.struct(
                    F.lit(check).alias("check"),
                    F.lit(name).alias("column_name"),
                    F.col(f"{check}_{name}").alias("violations"),
                )
                for check, name in broken
            ])
        )
    )
    if table.key:
        repeated = check_unique_key(df, [table.key]).agg(F.count("*").alias("violations"))
        found = found.unionByName(
            repeated.select(F.lit("unique_key").alias("check"), F.lit(table.key).alias("column_name"), "violations")
        )
    return found.filter("violations > 0")


def _conform(df: DataFrame, table: StarTable, name: str) -> DataFrame:
    """The table's columns in its order; a null in a required one fails the write itself, and so does a value that its type does not hold.

    Parquet tables do not enforce NOT NULL, and a check before the write would
    compute the rows twice. Outside ANSI mode a plain cast would wrap.
    """

    def column(field: T.StructField) -> Column:
        dtype = T.StringType() if isinstance(field.dataType, T.VarcharType) else field.dataType
        given = F.col(field.name)
        value = given.try_cast(dtype)
        wrong = F.concat(F.lit(f"{name}.{field.name} does not fit: "), given.cast("string"))
        value = F.when(given.isNotNull() & value.isNull(), F.raise_error(wrong).cast(dtype)).otherwise(value)
        if not field.nullable:
            error = F.raise_error(F.lit(f"{name}.{field.name} is null")).cast(dtype)
            value = F.when(value.isNull(), error).otherwise(value)
        return value.alias(field.name)

    # Tables keep their partition column last, and insertInto goes by position.
    ordered = sorted(table.columns, key=lambda f: f.name == table.partition_by)
    return df.select(*[column(field) for field in ordered])


def load_fact(
    df: DataFrame,
    database: str,
    name: str,
    tables: dict[str, StarTable] = STAR_SCHEMA,
    start: date | None = None,
    end: date | None = None,
) -> None:
    """Write the days in ``df`` into a fact table, replacing those days only.

    With ``start`` (and ``end``) the load is of these days: those of them without rows become empty.
    """
    spark, table = df.sparkSession, tables[name]
    rows = _conform(df, table, name)
    target = f"{database}.{name}"
    properties = spark.sql(f"SHOW TBLPROPERTIES {target} ('{BUCKET_COUNT_PROPERTY}')")
    buckets = int(properties.first()["value"])
    # Rows of a day and bucket meet in one task and so in one file, unless they are many.
    columns, day = rows.columns, table.partition_by
    placed = rows.withColumn("_bucket", F.pmod(F.hash(table.bucket_by), F.lit(buckets)))
    placed = gathered(placed, day, "_bucket").select(*columns)
    written = Observation()
    placed.observe(written, F.collect_set(day).alias("days")).write.insertInto(target, overwrite=True)
    if start is not None:
        inside = spark.table(target).filter(F.col(day).between(F.lit(start), F.lit(end or start)))
        kept = observed(written, lambda: days_of(rows, day))["days"]
        for gone in sorted(set(days_of(inside, day)["days"]) - set(kept)):
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (`{day}` = DATE'{gone}')")


def load_dimension(df: DataFrame, database: str, name: str, tables: dict[str, StarTable] = STAR_SCHEMA) -> None:
    """Replace the rows of a dimension; a repeated key, a null in one or a text too long is an error.

    The rows are computed once: what is checked is what is written.
    """
    table = tables[name]
    rows = staged(_conform(df, table, name), name)
    broken = find_violations(rows, table).collect()  # a row for each constraint at most
    if broken:
        told = "; ".join(f"{r['violations']} of {r['check']} on {r['column_name']}" for r in broken)
        raise ValueError(f"{name} breaks its constraints: {told}")
    rows.write.insertInto(f"{database}.{name}", overwrite=True)
