"""Landing files and Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, Observation, functions as F, types as T

from tidelake.schemas import WritePolicy
from tidelake.session import staged
from tidelake.sources.files import CSV_DIALECT

#: The day of the file that a row without a day came in; in silver only files of such rows have it.
FILE_DAY = "_file_day"
# How many tasks write one group of rows where adaptive execution is off.
TASKS_A_GROUP = 8
# Nothing is cut: neither blanks at the ends of a text nor digits of a time, and null is not empty.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
CSV_WRITE = CSV_DIALECT | TIMES | {"nullValue": "", "emptyValue": '""', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def gathered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with equal ``columns`` in few tasks, large groups still in many.

    Adaptive execution splits what is large. Without it a group is dealt to at most
    ``TASKS_A_GROUP`` tasks by a hash of its rows.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df.repartition(*columns, F.pmod(F.xxhash64(*df.columns), F.lit(TASKS_A_GROUP)))
    return df.hint("rebalance", *columns)


def observed(observation: Observation, otherwise: Callable[[], dict]) -> dict:
    """What an observation of a finished write saw.

    Adaptive execution turns a plan that has come out empty into no plan, and its metrics are then missing: ``otherwise``
    computes them again, which costs little where there is nothing.
    """
    try:
        return observation.get
    except Py4JJavaError as error:
        # What a row without metrics raises on its way to Python.
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return otherwise()


def days_of(rows: DataFrame, day: str) -> dict:
    return {"days": [row[0] for row in rows.select(day).distinct().collect()]}


def replace_days(rows: DataFrame, path: str, policy: WritePolicy, start: date, end: date) -> None:
    """Write the days ``start`` to ``end`` of a table that is partitioned by day; those without rows become empty.

    Rows without a day are told apart by ``FILE_DAY``, if ``rows`` have it: those of files of these days are replaced.
    """
    spark, day = rows.sparkSession, policy.partition_by
    undated = rows.filter(F.col(day).isNull()) if FILE_DAY in rows.columns else None
    rows, written = rows.drop(FILE_DAY), Observation()
    schema = rows.schema
    seen = rows.observe(written, F.collect_set(day).alias("days"), F.count_if(F.col(day).isNull()).alias("undated"))
    write_table(seen if undated is None else seen.filter(F.col(day).isNotNull()), path, policy, gather=end > start)
    found = observed(written, lambda: days_of(rows, day) | {"undated": 0 if undated is None else undated.count()})
    kept = [d for d in found["days"] if d is not None]
    if undated is not None:
        _replace_undated(undated, found["undated"], path, policy, start, end)
    inside = spark.read.schema(schema).parquet(path).filter(F.col(day).between(F.lit(start), F.lit(end)))
    rest = T.StructType([f for f in schema if f.name != day])
    for gone in sorted(set(days_of(inside, day)["days"]) - set(kept)):
        spark.createDataFrame([], rest).write.mode("overwrite").parquet(f"{path}/{day}={gone}")


def replace_listed_days(rows: DataFrame, path: str, policy: WritePolicy, days: Sequence[date]) -> None:
    """Write ``days``, which need not follow each other, of a table partitioned by day; all of ``rows`` are of these days, and those without rows become empty."""
    spark, day = rows.sparkSession, policy.partition_by
    write_table(rows, path, policy)
    inside = spark.read.schema(rows.schema).parquet(path).filter(F.col(day).isin(list(days)))
    rest = T.StructType([f for f in rows.schema if f.name != day])
    for gone in sorted(set(days_of(inside, day)["days"]) - set(days_of(rows, day)["days"])):
        spark.createDataFrame([], rest).write.mode("overwrite").parquet(f"{path}/{day}={gone}")


def _replace_undated(undated: DataFrame, n: int, path: str, policy: WritePolicy, start: date, end: date) -> None:
    """Write the ``n`` rows without a day; those held from files of other days than ``start`` to ``end`` stay."""
    spark, day = undated.sparkSession, policy.partition_by
    held = spark.read.schema(undated.schema).parquet(path).filter(F.col(day).isNull())
    gone = F.col(FILE_DAY).between(F.lit(start), F.lit(end))
    if not n and held.filter(gone).isEmpty():
        return
    # Written first, as the partition is read and replaced.
    after = staged(held.filter(~F.coalesce(gone, F.lit(False))).unionByName(undated), "undated")
    if after.isEmpty():
        rest = T.StructType([f for f in undated.schema if f.name != day])
        spark.createDataFrame([], rest).write.mode("overwrite").parquet(f"{path}/{day}=__HIVE_DEFAULT_PARTITION__")
    else:
        write_table(after, path, policy, gather=False)


def _landing(df: DataFrame) -> DataFrameWriter:
    """Replaces the whole path, or the days that occur if rows have an ``as_of_date``."""
    if "as_of_date" not in df.columns:
        return df.write.mode("overwrite")
    writer = gathered(df, "as_of_date").write.partitionBy("as_of_date")
    return writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")


def write_csv(df: DataFrame, path: str, day_column: str | None = None) -> None:
    """Replace ``path`` by CSV files with a header, quotes doubled inside quoted fields.

    With ``day_column`` one job lands many days, each in its own folder.
    """
    if day_column:
        df = df.withColumn("as_of_date", F.col(day_column))
    _landing(df).options(**CSV_WRITE).csv(path)


def write_json(df: DataFrame, path: str, wrapped: bool = False, day_column: str | None = None) -> None:
    """Replace ``path`` by JSON text: an array of objects per line, ``wrapped`` as ``{"data": [...]}``.

    With ``day_column`` one job lands many days, each in its own folder.
    """
    array = F.array(F.struct(*df.columns))
    content = F.struct(array.alias("data")) if wrapped else array
    days = [F.col(day_column).alias("as_of_date")] if day_column else []
    _landing(df.select(F.to_json(content, {"ignoreNullFields": "false", **TIMES}).alias("value"), *days)).text(path)


def write_table(df: DataFrame, path: str, policy: WritePolicy, gather: bool = True) -> None:
    """Write ``df`` as Parquet by ``policy``.

    Rows are gathered by partition value to get few files per partition; ``gather=False``
    saves that shuffle for rows of a single partition. An appended day without rows
    leaves its partition as it was.
    """
    writer = df.write
    if policy.partition_by:
        overwrite = "dynamic" if policy.mode == "append" else "static"
        rows = gathered(df, policy.partition_by) if gather else df
        writer = rows.write.partitionBy(policy.partition_by).option("partitionOverwriteMode", overwrite)
    elif policy.mode == "append":
        writer.mode("append").parquet(path)
        return
    writer.mode("overwrite").parquet(path)
