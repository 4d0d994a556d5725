"""Landing files that may be rewritten in place into silver: a changed file's rows replace those it held before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidelake.operators.quality import clean
from tidelake.schemas import OUT_OF_STOCK_SCHEMA, WritePolicy
from tidelake.session import staged
from tidelake.sinks.files import replace_listed_days
from tidelake.sources.files import DAY_FILES, read_bronze_json
from tidelake.sources.ledger import Ledger, content_prints, landed, unit_of


@dataclass(frozen=True)
class Taken:
    """How many landed units were new, changed, written again with the same content, or not touched."""

    new: int = 0
    changed: int = 0
    same: int = 0
    untouched: int = 0


def take_landed(
    spark: SparkSession,
    landing: str,
    path: str,
    state: str,
    schema: T.StructType = OUT_OF_STOCK_SCHEMA,
    layout: str = DAY_FILES,
    wrapped: bool = False,
    one_array: bool = False,
    partition_by: str = "date",
) -> Taken:
    """Bring the silver table at ``path`` up to what lies below ``landing``.

    A unit is a file, or the folder of a day. One whose length or time differs from the ledger's is read; if its content does, its rows replace
    those that it gave before. ``state`` holds the ledger and, by day, which unit gave which rows, as several may give the same row. Only
    days that changed units gave or give are read and written, in both tables. A unit that is gone keeps its rows. A row of nulls in a column of ``schema``
    is dropped, rows are distinct by day. Names of changed files and their days go through the driver, rows never. Run again after a
    failure it does what was left undone, as entries of the ledger are written last.
    """
    ledger, rows_path, policy = Ledger(spark, f"{state}/ledger"), f"{state}/rows", WritePolicy("append", partition_by)
    units = landed(spark, landing, layout)
    last = ledger.last("landed").select(F.col("name").alias("unit"), *[F.col(c).alias(f"last_{c}") for c in ("length", "modified", "n", "a", "b", "days")])
    units = units.join(last, "unit", "left").unionByName(_not_listed(spark, ledger, units, last))
    touched = ~(F.col("length").eqNullSafe(F.col("last_length")) & F.col("modified").eqNullSafe(F.col("last_modified")))
    units = staged(units.withColumn("touched", touched), "landed")
    files = [f for row in units.filter("touched").select("files").collect() for f in row["files"]]
    untouched, moved = units.agg(F.count_if(~F.col("touched")), F.count_if("touched")).first()
    if not moved:
        return Taken(untouched=untouched)
    prints = content_prints(spark, files, "json", layout) if files else ledger.last("none").selectExpr("name AS unit", "n", "a", "b")
    seen = units.filter("touched").join(prints, "unit", "left").fillna(0, ["n"]).withColumns({c: F.coalesce(c, F.lit(0)).cast("decimal(38,0)") for c in "ab"})
    is_new, is_same = F.col("last_n").isNull(), F.col("n").eqNullSafe(F.col("last_n")) & F.col("a").eqNullSafe(F.col("last_a")) & F.col("b").eqNullSafe(F.col("last_b"))
    seen = staged(seen.withColumns({"is_new": is_new, "is_same": is_same}), "seen")
    new, same, every = seen.agg(F.count_if("is_new"), F.count_if("is_same"), F.count("*")).first()
    changed = seen.filter("NOT is_same")
    given = _rows_of(spark, [f for row in changed.select("files").collect() for f in row["files"]], schema, layout, wrapped, one_array)
    days = given.groupBy("unit").agg(F.collect_set(partition_by).alias("given_days"))
    changed = staged(changed.join(days, "unit", "left").withColumn("given_days", F.coalesce("given_days", F.array().cast("array<date>"))), "changed")
    if same < every:
        both = F.explode(F.array_union("given_days", F.coalesce("last_days", F.array().cast("array<date>"))))
        moved = sorted(row[0] for row in changed.select(both.alias("day")).distinct().collect())
        spark.createDataFrame([], given.schema).write.mode("ignore").partitionBy(partition_by).parquet(rows_path)
        spark.createDataFrame([], schema).write.mode("ignore").partitionBy(partition_by).parquet(path)
        held = spark.read.schema(given.schema).parquet(rows_path).filter(F.col(partition_by).isin(moved))
        # Written first, as days are read and replaced.
        after = staged(held.join(changed.select("unit"), "unit", "left_anti").unionByName(given), "landed-rows")
        replace_listed_days(after, rows_path, policy, moved)
        replace_listed_days(after.select(*schema.fieldNames()).dropDuplicates(), path, policy, moved)
    entry = [F.col("unit").alias("name"), "length", "modified", "n", "a", "b"]
    again = seen.filter("is_same").select(*entry, F.col("last_days").alias("days"))
    ledger.add("landed", again.unionByName(changed.select(*entry, F.col("given_days").alias("days"))))
    return Taken(new, every - new - same, same, untouched)


def _not_listed(spark: SparkSession, ledger: Ledger, units: DataFrame, last: DataFrame) -> DataFrame:
    """Units of the ledger that have become empty, which Spark does not list; those that are gone are noted, so that they are not looked for again."""
    away = last.join(units.select("unit"), "unit", "left_anti").filter("last_length > 0")
    hadoop, names = spark.sparkContext._jvm.org.apache.hadoop.fs, [row[0] for row in away.select("unit").collect()]
    paths = [hadoop.Path(spark.sparkContext._jvm.java.net.URI(name)) for name in names]
    there = [p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p) for p in paths]
    told = spark.createDataFrame(list(zip(names, there, strict=True)), "unit string, is_there boolean")
    gone = staged(away.join(told.filter("NOT is_there"), "unit"), "gone")
    if not all(there):
        entry = [F.col(f"last_{c}").alias(c) for c in ("n", "a", "b", "days")]
        ledger.add("landed", gone.select(F.col("unit").alias("name"), *entry))
    empty = away.join(told.filter("is_there"), "unit").drop("is_there")
    columns = {"day": "date", "modified": "timestamp"}
    empty = empty.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()} | {"length": F.lit(0).cast("long")})
    return empty.withColumn("files", F.array().cast("array<string>"))


def _rows_of(spark: SparkSession, files: list[str], schema: T.StructType, layout: str, wrapped: bool, one_array: bool) -> DataFrame:
    """Distinct rows of every unit, with its name."""
    names = schema.fieldNames()
    if not files:
        return spark.createDataFrame([], T.StructType([*schema, T.StructField("unit", T.StringType())]))
    rows = read_bronze_json(spark, files, schema, wrapped, multiline=one_array, file_column="_file")
    rows = clean(rows.withColumn("unit", unit_of(F.col("_file"), layout)).drop("_file"), names)
    return staged(rows.select(*names, "unit"), "given")
