"""Row cleaning, and the checks a warehouse makes with constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F


def clean(
    df: DataFrame,
    not_null: Sequence[str] = (),
    dedupe: bool = True,
    observation: Observation | None = None,
) -> DataFrame:
    """Drop rows with a null in any of ``not_null``, then repeated full rows.

    ``observation`` receives ``rows_read`` and ``rows_dropped_null`` from the same
    pass once an action has run.
    """
    if observation is not None:
        has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in not_null], F.lit(False))
        df = df.observe(
            observation, F.count("*").alias("rows_read"), F.count_if(has_null).alias("rows_dropped_null")
        )
    if not_null:
        df = df.dropna(subset=list(not_null))
    return df.dropDuplicates() if dedupe else df


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (column_name, violations) per column that holds nulls; one pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns])
    return counts.select(F.inline(pairs)).filter("violations > 0")


def check_unique_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("row_cnt")).filter("row_cnt > 1")


def check_max_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows in which a text is longer than its column allows."""
    too_long = [F.length(name) > limit for name, limit in limits.items()]
    return df.filter(reduce(lambda a, b: a | b, too_long, F.lit(False)))
