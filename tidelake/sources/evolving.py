"""CSV files whose columns come, go or move: read by name, into a schema that a ledger keeps and that only widens."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidelake.sources.files import read_bronze_csv

#: Numbers from the narrowest to the widest: a value of one fits into all that follow.
_WIDER = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The narrower of the two types into which both fit, without loss; nothing where there is none."""
    if old == new:
        return old
    if old in _WIDER and new in _WIDER:
        return max(old, new, key=_WIDER.index)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        digits = max(old.precision - old.scale, new.precision - new.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    if {type(old), type(new)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    return None


def evolved(held: T.StructType, declared: T.StructType) -> T.StructType:
    """``held`` with the columns of ``declared`` that it lacks behind it, and types as wide as either.

    A column declared narrower than it is held, or of another kind, is an error: rows that are held would not fit. One that ``declared`` lacks stays.
    """
    fields = {f.name: f for f in held}
    for f in declared:
        before = fields.get(f.name)
        if before is None:
            fields[f.name] = T.StructField(f.name, f.dataType)
            continue
        wide = widened(before.dataType, f.dataType)
        if wide is None or wide != f.dataType:
            raise ValueError(f"column {f.name} can't go from {before.dataType.simpleString()} to {f.dataType.simpleString()}")
        fields[f.name] = T.StructField(f.name, wide)
    return T.StructType(list(fields.values()))


class SchemaLedger:
    """The versions of a table's schema, each a row of a Parquet folder that only grows; the last one holds."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        spark.createDataFrame([], "version long, schema string").write.mode("ignore").parquet(path)

    def versions(self) -> list[T.StructType]:
        """Oldest first; one for each change that was declared."""
        rows = self.spark.read.schema("version long, schema string").parquet(self.path).orderBy("version").collect()
        return [T.StructType.fromJson(json.loads(row["schema"])) for row in rows]

    def declare(self, schema: T.StructType) -> T.StructType:
        """The table's schema once ``schema`` is declared; a new version is kept only if it differs."""
        held = self.versions()
        now = evolved(held[-1], schema) if held else T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        if not held or now != held[-1]:
            row = [(len(held), now.json())]
            self.spark.createDataFrame(row, "version long, schema string").coalesce(1).write.mode("append").parquet(self.path)
        return now


def headers(spark: SparkSession, paths: Sequence[str], at_once: int = 16) -> dict[str, tuple[str, ...]]:
    """The columns that each file below ``paths`` names in its first line; files without a line have none. The first lines alone are read, by the driver."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    files = [row[0] for row in listed.select("_metadata.file_path").collect()]

    def first_line(name: str) -> tuple[str, ...]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = path.getFileSystem(conf).open(path)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        return tuple(next(csv.reader(io.StringIO(line)))) if line else ()

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(files, pool.map(first_line, files), strict=True))


def read_evolving_csv(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    multiline: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """Rows of files that name the columns of ``schema`` in any order; one that a file lacks is null, one that ``schema`` lacks an error.

    Files of one header are one scan, so there are as many as headers. A header that names a column twice is an error.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, names in headers(spark, paths).items():
        if names:
            by_header.setdefault(names, []).append(path)
    types = {f.name.lower(): f for f in schema}
    path_field = [T.StructField(file_column, T.StringType())] if file_column else []
    rows = spark.createDataFrame([], T.StructType([*schema, *path_field]))
    for names, files in sorted(by_header.items()):
        unknown = [n for n in names if n.lower() not in types]
        if unknown or len({n.lower() for n in names}) < len(names):
            raise ValueError(f"header {', '.join(names)} of {files[0]}: {', '.join(unknown) or 'a column'} not in the schema, or twice")
        own = T.StructType([types[n.lower()] for n in names])
        found = read_bronze_csv(spark, files, own, multiline, file_column)
        kept = [F.col(f.name) if f.name in own.fieldNames() else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        rows = rows.unionByName(found.select(*kept, *([file_column] if file_column else [])))
    return rows
