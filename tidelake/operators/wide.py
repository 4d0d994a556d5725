"""Full-row dedupe of wide Parquet tables without shuffling the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.session import staged

_PLACE = ("_file", "_index")
_DIGEST = ("_a", "_b")


def _digests(columns: Sequence[str]) -> list[Column]:
    """128 bits of a row; nulls count by their place, as hashes pass over them."""
    own = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(F.lit(""), *[c.isNull().cast("int").cast("string") for c in own])
    return [F.xxhash64(F.lit(seed), nulls, *own).alias(name) for seed, name in enumerate(_DIGEST)]


def distinct_rows(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The distinct rows of Parquet files, of all columns or some; of equal rows the first by file and place stays.

    Digests and places are shuffled, not rows. Rows whose digest occurs again, and only these, are read a second time and compared in all their columns, so
    rows of equal digests that differ all stay. What is dropped is a written list of places: rows meet it without a shuffle while it is
    small enough to broadcast. Columns may be of any type that can be grouped; their names must not be ``_file``, ``_index``, ``_a`` or ``_b``.
    """
    table = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    columns = list(columns or table.columns)
    if taken := sorted({*_PLACE, *_DIGEST} & set(columns)):
        raise ValueError(f"column names in use: {', '.join(taken)}")
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")]
    rows = table.select(*[F.col(f"`{c}`") for c in columns], *place)
    digests = rows.select(*_digests(columns), *_PLACE)
    again = digests.groupBy(*_DIGEST).agg(F.count("*").alias("n")).filter("n > 1").select(*_DIGEST)
    suspects = staged(digests.join(again, list(_DIGEST), "left_semi").select(*_PLACE), "equal-digests")
    # Rows alike in a task are one row before they are shuffled; the first of each stays.
    held = rows.join(suspects, list(_PLACE), "left_semi")
    firsts = held.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.min(F.struct(*_PLACE)).alias("first")).select("first.*")
    gone = staged(suspects.join(staged(firsts, "first-rows"), list(_PLACE), "left_anti"), "repeated-rows")
    return rows.join(gone, list(_PLACE), "left_anti").select(*[F.col(f"`{c}`") for c in columns])
