"""New landing files of the feed into its silver table, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidelake.operators.quality import clean
from tidelake.schemas import OUT_OF_STOCK_SCHEMA
from tidelake.session import staged
from tidelake.sinks.files import gathered


def add_new_rows(rows: DataFrame, path: str, schema: T.StructType, partition_by: str) -> None:
    """Append to the table at ``path`` the distinct rows, free of nulls, it does not hold yet.

    Of the table only the partitions of the days in ``rows`` are read, and none is rewritten, so a late
    file for a large day costs a read of that day and a small append. Run again after a
    failure, it finds what was already added. The rows are written to the shared folder first, as they are read twice.
    """
    spark = rows.sparkSession
    # Makes the table's folder the first time.
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(partition_by).parquet(path)
    rows = staged(rows.select(*schema.fieldNames()).dropDuplicates(), "ingest")
    present = touched_days(spark.read.schema(schema).parquet(path), rows, partition_by)
    fresh = rows.join(present, schema.fieldNames(), "left_anti")
    gathered(fresh, partition_by).write.partitionBy(partition_by).mode("append").parquet(path)


def touched_days(table: DataFrame, rows: DataFrame, partition_by: str) -> DataFrame:
    """``table``'s rows of the days that occur in ``rows``: their partitions alone are listed and read.

    The days, a row for each calendar day, are broadcast; the comparison, true of any day, is what lets Spark prune by them at run time.
    """
    days = rows.select(partition_by).filter(F.col(partition_by) >= F.lit("0001-01-01").cast("date")).distinct()
    return table.join(F.broadcast(days), partition_by, "left_semi")


def ingest_feed(
    spark: SparkSession,
    landing: str,
    path: str,
    checkpoint: str,
    schema: T.StructType = OUT_OF_STOCK_SCHEMA,
    max_files_per_batch: int | None = None,
) -> None:
    """Read every file landed since the last call, whatever its name, and add its rows to silver; compressed ones by their ending.

    A name that begins with ``_`` or ``.`` is not landed yet. All new files are one batch unless ``max_files_per_batch`` cuts a backlog into several.
    Rows are made distinct inside a batch and against the table, not by streaming
    state, which would grow for ever. A file rewritten in place is not read again: ``take_landed`` does, and so
    does the batch job for its day.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    landed = reader.json(landing)

    def add_batch(batch: DataFrame, _batch_id: int) -> None:
        add_new_rows(clean(batch, schema.fieldNames(), dedupe=False), path, schema, "date")

    query = (
        landed.writeStream.foreachBatch(add_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
