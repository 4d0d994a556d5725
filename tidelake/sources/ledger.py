"""What has landed and what has been taken of it: fingerprints that do not depend on order, kept in a ledger.

A ledger is a Parquet folder that only grows; of each name and day its last entry counts. An entry is written after what it stands for, so a run
that fails in between is made up for by the next one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidelake.sources.files import DAY_FILES, file_day

#: A layer's table or landed unit, its day if it has one; what its files look like and hold; the days of its rows.
_PRINT = {"n": T.LongType(), "a": T.DecimalType(38, 0), "b": T.DecimalType(38, 0)}
_ENTRY = {"layer": T.StringType(), "name": T.StringType(), "day": T.DateType(), "length": T.LongType(), "modified": T.TimestampType()}
_ENTRY |= _PRINT | {"days": T.ArrayType(T.DateType()), "taken": T.LongType()}
SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in _ENTRY.items()])
#: What ends a piece of text that is hashed as one.
PIECE_ENDS = {"csv": "\n", "json": "}"}


def _hashed(*columns: Column) -> list[Column]:
    """How many there are, and the sums of two hashes: 128 bits that do not depend on order but on repeats."""
    nulls = F.concat(F.lit(""), *[c.isNull().cast("int").cast("string") for c in columns])
    hashes = (F.xxhash64(F.lit(seed), nulls, *columns).cast("decimal(38,0)") for seed in (1, 2))
    return [F.count("*").alias("n"), *(F.coalesce(F.sum(h), F.lit(0)).cast("decimal(38,0)").alias(name) for name, h in zip("ab", hashes, strict=True))]


def row_prints(rows: DataFrame, *by: str) -> DataFrame:
    """``n, a, b`` of the rows of each ``by``; the order of rows and columns' places in files do not matter."""
    return rows.groupBy(*by).agg(*_hashed(*[F.col(c) for c in sorted(rows.columns)]))


def unit_of(path: Column, layout: str = DAY_FILES) -> Column:
    """What lands as one: a day's file, or its folder; a file that is named otherwise is a unit of its own."""
    head = F.regexp_extract(path, r"^(.*/as_of_date=\d{4}-\d{2}-\d{2})/", 1) if layout != DAY_FILES else F.lit("")
    return F.when(head != "", head).otherwise(path)


def landed(spark: SparkSession, root: str, layout: str = DAY_FILES) -> DataFrame:
    """``unit, day, length, modified, files`` of everything below ``root``: listed, not read. Names that begin with ``_`` or ``.`` are not landed yet."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    path = F.col("_metadata.file_path")
    files = files.select(path.alias("path"), "length", F.col("modificationTime").alias("modified"))
    units = files.groupBy(unit_of(F.col("path"), layout).alias("unit"))
    units = units.agg(F.sum("length").alias("length"), F.max("modified").alias("modified"), F.sort_array(F.collect_list("path")).alias("files"))
    return units.select("unit", file_day(F.col("files")[0], layout).alias("day"), "length", "modified", "files")


def content_prints(spark: SparkSession, files: Sequence[str], extension: str, layout: str = DAY_FILES) -> DataFrame:
    """``unit, n, a, b`` of the texts of ``files``, read in blocks; pieces in another order are the same content. Empty files have none."""
    pieces = spark.read.option("lineSep", PIECE_ENDS[extension]).option("recursiveFileLookup", True).text(list(files))
    pieces = pieces.select(unit_of(F.col("_metadata.file_path"), layout).alias("unit"), "value")
    return pieces.groupBy("unit").agg(*_hashed(F.col("value")))


class Ledger:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(path)

    def last(self, layer: str) -> DataFrame:
        """The last entry of every name and day of a layer."""
        entries = self.spark.read.schema(SCHEMA).parquet(self.path).filter(F.col("layer") == layer)
        latest = F.max_by(F.struct("length", "modified", "n", "a", "b", "days"), "taken")
        return entries.groupBy("name", "day").agg(latest.alias("entry")).select("name", "day", "entry.*")

    def add(self, layer: str, entries: DataFrame) -> None:
        """Columns that ``entries`` lack are null; they are few, a unit or a day each, and written as one file."""
        taken = self.spark.read.schema(SCHEMA).parquet(self.path).agg(F.coalesce(F.max("taken"), F.lit(0))).first()[0] + 1
        own = {"layer": F.lit(layer), "taken": F.lit(taken)}
        columns = [own[f.name] if f.name in own else F.col(f.name) if f.name in entries.columns else F.lit(None) for f in SCHEMA]
        entries = entries.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, SCHEMA, strict=True)])
        entries.coalesce(1).write.mode("append").parquet(self.path)

    def moved(self, layer: str, now: DataFrame) -> DataFrame:
        """Entries ``name, day, n, a, b`` of ``now`` that the last ones of the layer do not have just so."""
        names = ("name", "day", "n", "a", "b")
        kept = self.last(layer).select(*[F.col(c).alias(f"last_{c}") for c in names])
        return now.join(kept, [F.col(c).eqNullSafe(F.col(f"last_{c}")) for c in names], "left_anti")
