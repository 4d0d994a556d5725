"""Top-k with and without ties, and the first row per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidelake.operators.skew import lookup_join
from tidelake.session import staged


def top_k(df: DataFrame, value: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The ``k`` rows of highest ``value``, nulls last, equal values in the order of ``tie``."""
    return df.orderBy(F.desc_nulls_last(value), *[F.asc(c) for c in tie]).limit(k)


def top_n_dense(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose ``value`` is among the ``n`` highest distinct values, all ties kept.

    A window over all rows would gather every tied row in one task. Here only
    the ``n`` values are gathered, and joined back.
    """
    best = df.select(value).distinct().orderBy(F.desc_nulls_last(value)).limit(n)
    # n rows by the limit, so it can be broadcast.
    return df.join(F.broadcast(best), value, "left_semi")


def dense_ranks(df: DataFrame, value: str, rank: str = "rank") -> DataFrame:
    """``df`` with the dense rank of every row by ``value``, highest first, nulls last as one value.

    The distinct values alone are sorted, dealt by ranges. A value's rank is its place in its range and the number of values in the ranges before,
    which the driver adds up: a number for each range. Ranks return to the rows by a join that splits hot values, so no task gets all rows or all ties.
    """
    spark = df.sparkSession
    values = df.select(value).filter(F.col(value).isNotNull()).distinct().repartitionByRange(F.desc(value)).sortWithinPartitions(F.desc(value))
    # The number's high bits are the range, the others count the rows in it.
    placed = staged(values.withColumn("_place", F.monotonically_increasing_id()), "distinct-values")
    part, base, before = F.shiftright("_place", 33), 0, []
    for row in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        before.append((row["part"], base))
        base += row["count"]
    bases = F.broadcast(spark.createDataFrame(before, "_part long, _base long"))
    ranks = placed.join(bases, part == F.col("_part")).select(value, (F.col("_base") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(rank))
    # Written, so that its true size decides about a broadcast.
    ranks = staged(ranks, "ranks")
    return lookup_join(df, ranks, value, "left").withColumn(rank, F.coalesce(rank, F.lit(base + 1).cast("long")))


def top1_per_class(df: DataFrame, by: str, value: str, tie: str) -> DataFrame:
    """One row per ``by``: the highest ``value``, nulls last, then the lowest ``tie``.

    Catalyst turns the filter into a group limit before the shuffle, so a task
    sends one row per class however many it holds.
    """
    order = Window.partitionBy(by).orderBy(F.desc_nulls_last(value), F.asc(tie))
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
