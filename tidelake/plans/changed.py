"""A range of days again, where only what has changed since is computed.

Each layer of each day has a fingerprint: the landed text of bronze, the rows of silver. What a layer was made from is kept in a ledger below the silver
tables, written after the layer itself; a day whose fingerprint is the one that is kept is left as it is.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidelake.plans.jobs import GOLD_DIMENSIONS, GOLD_FACTS, SILVER_SCHEMAS, Lake, clean_out_of_stock, clean_shop_table, load_gold
from tidelake.schemas import WRITE_POLICIES, WritePolicy, write_policy
from tidelake.session import staged
from tidelake.sources.files import date_range, read_silver
from tidelake.sources.ledger import Ledger, content_prints, landed, row_prints

# Fixed value: the silver tables that a dimension is made from.
SOURCES = {
    "dim_clients": ("clients", "location_areas"),
    "dim_products": ("products", "departments", "aisles"),
    "dim_stores": ("stores", "store_types", "location_areas"),
}


@dataclass
class Rewritten:
    """What a run has written: the days of each table; of a table without days, the last day of the run."""

    silver: dict[str, list[date]] = field(default_factory=dict)
    gold: dict[str, list[date]] = field(default_factory=dict)


def runs_of_days(days: Collection[date]) -> list[tuple[date, date]]:
    """First and last of each run of successive days."""
    runs: list[tuple[date, date]] = []
    for day in sorted(days):
        if runs and day - runs[-1][1] == timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def _bronze_prints(spark: SparkSession, lake: Lake, ledger: Ledger, table: str, days: list[date]) -> DataFrame:
    """``name, day, length, modified, n, a, b`` of the landed days; text is read only where length or time differ from the ledger's."""
    feed = table == "out_of_stock"
    folder = f"{lake.bronze.rstrip('/')}/{lake.feed if feed else f'{lake.source}/{table}'}"
    units = landed(spark, folder, lake.bronze_layout).filter(F.col("day").isin(days))
    last = ledger.last("bronze").filter(F.col("name") == table)
    last = last.select(F.col("day").alias("last_day"), F.col("length").alias("last_length"), F.col("modified").alias("last_modified"), "n", "a", "b")
    same = (F.col("day") == F.col("last_day")) & (F.col("length") == F.col("last_length")) & (F.col("modified") == F.col("last_modified"))
    units = staged(units.join(last, same, "left"), "landed-days")
    here = {row["day"] for row in units.select("day").collect()}
    if missing := sorted(set(days) - here):
        raise FileNotFoundError(f"{table} has not landed for {', '.join(map(str, missing))}")
    kept = units.filter("last_day IS NOT NULL").select("day", "length", "modified", "n", "a", "b")
    files = [f for row in units.filter("last_day IS NULL").select("files").collect() for f in row["files"]]
    if files:
        zero = F.lit(0)
        read = content_prints(spark, files, "json" if feed else "csv", lake.bronze_layout)
        fresh = units.filter("last_day IS NULL").select("unit", "day", "length", "modified").join(read, "unit", "left")
        kept = kept.unionByName(fresh.select("day", "length", "modified", *[F.coalesce(c, zero).cast(t).alias(c) for c, t in (("n", "long"), ("a", "decimal(38,0)"), ("b", "decimal(38,0)"))]))
    return kept.withColumn("name", F.lit(table))


def _days_of(moved: DataFrame) -> list[date]:
    return sorted(row["day"] for row in moved.select("day").collect())


def run_changed(
    spark: SparkSession,
    lake: Lake,
    start: date,
    end: date | None = None,
    tables: Sequence[str] | None = None,
    schemas: Mapping[str, T.StructType] = SILVER_SCHEMAS,
    policies: dict[str, WritePolicy] = WRITE_POLICIES,
    gold_tables: Sequence[str] = GOLD_FACTS + GOLD_DIMENSIONS,
    multiline: Collection[str] = (),
) -> Rewritten:
    """``run_range`` for the days whose landed text, or whose silver rows, are not those of the last run.

    A day that landed again with the same content is read but not written. A day whose new text gives the same rows is written to silver and left alone in gold. Of tables
    that each day replaces, the last day counts. A day that has not landed is an error. Listings, fingerprints and days go through the
    driver, a row for each table and day. A run that failed is made up for by the next one. Layers written otherwise are not noticed.
    """
    last_day, ledger, done = end or start, Ledger(spark, f"{lake.silver.rstrip('/')}/_ledger"), Rewritten()
    tables = [t for t in schemas if t != "out_of_stock"] if tables is None else list(tables)
    for table in [*tables, *(["out_of_stock"] if "out_of_stock" in schemas else [])]:
        policy = write_policy(table, policies)
        days = date_range(start, last_day) if policy.partition_by and policy.mode == "append" else [last_day]
        prints = staged(_bronze_prints(spark, lake, ledger, table, days), "bronze-prints")
        snapshot = len(days) == 1 and not policy.partition_by
        # A snapshot is the same whichever day it landed on.
        named = prints.withColumn("day", F.lit(None).cast("date")) if snapshot else prints
        moved = [last_day] if snapshot and ledger.moved("bronze", named).count() else [] if snapshot else _days_of(ledger.moved("bronze", prints))
        for first, last in runs_of_days(moved):
            if table == "out_of_stock":
                clean_out_of_stock(spark, lake, first, last, schemas[table], policies)
            else:
                clean_shop_table(spark, lake, table, first, last, schemas, policies, multiline=table in multiline)
        if moved:
            done.silver[table] = moved
            ledger.add("silver", _silver_prints(spark, lake, table, schemas[table], policy, None if snapshot else moved))
        if snapshot:
            prints = named.unionByName(prints)
        ledger.add("bronze", prints)
    for table in gold_tables:
        sources, is_fact = SOURCES.get(table, (table,)), table in GOLD_FACTS
        prints = ledger.last("silver").filter(F.col("name").isin(list(sources)))
        if is_fact:
            prints = prints.filter(F.col("day").between(F.lit(start), F.lit(last_day)))
        prints = prints.withColumn("name", F.concat(F.lit(f"{table} from "), F.col("name")))
        moved = staged(ledger.moved("gold", prints), "gold-moved")
        days = _days_of(moved) if is_fact else [last_day] * (moved.count() > 0)
        for first, last in runs_of_days(days):
            load_gold(spark, lake, table, first, last, schemas)
        if days:
            done.gold[table] = days
            ledger.add("gold", moved)
    return done


def _silver_prints(spark: SparkSession, lake: Lake, table: str, schema: T.StructType, policy: WritePolicy, days: list[date] | None) -> DataFrame:
    """Fingerprints of a table's rows, by day or, of one without days, of the whole; an empty day has one, too."""
    rows = read_silver(spark, lake.silver_path(table), schema)
    if days is None:
        return row_prints(rows.withColumn("day", F.lit(None).cast("date")), "day").withColumn("name", F.lit(table)) if rows.take(1) else _empty(spark, table, [None])
    every = row_prints(rows.withColumn("day", F.col(policy.partition_by)).filter(F.col("day").isin(days)), "day").withColumn("name", F.lit(table))
    return _empty(spark, table, days).join(every.select("day"), "day", "left_anti").unionByName(every)


def _empty(spark: SparkSession, table: str, days: list[date | None]) -> DataFrame:
    return spark.createDataFrame([(d, 0, table) for d in days], "day date, n long, name string").selectExpr("day", "n", "CAST(0 AS DECIMAL(38,0)) AS a", "CAST(0 AS DECIMAL(38,0)) AS b", "name")
