"""Equi-joins that hold when one key owns a large share of the rows.

A side that Catalyst broadcasts is left to Catalyst: no shuffle, no skew. Otherwise one
pass over the key column looks for hot keys: those with more rows than an average
shuffle partition. Without any, the join is a plain one. With some, the rows of each hot
key are spread over several salts, and the matching rows of the other side are repeated
once per salt.

Adaptive execution splits skewed joins as well, but not where a side was grouped by
the join key just before, or is grouped by it just after.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# A sketch of n counters finds every key above about 1 / (0.75 n) of the rows: with these for each shuffle partition, all hot ones.
COUNTERS_A_PARTITION = 4
# The most counters that Spark's sketch takes; enough for 250,000 shuffle partitions.
MOST_COUNTERS = 1_000_000
# Sketches are merged in this many groups before the last merge.
SKETCH_GROUPS = 64


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst will broadcast ``df`` in a join, going by its estimate.

    Spark Connect does not show the estimate; a frame there is taken for a large one, which costs a look for hot keys.
    """
    if not hasattr(df, "_jdf"):
        return False
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _any_null(keys: Sequence[str]) -> Column:
    condition = F.col(keys[0]).isNull()
    for key in keys[1:]:
        condition = condition | F.col(key).isNull()
    return condition


def hot_keys(df: DataFrame, keys: Sequence[str]) -> dict[int | None, int]:
    """Hash of each hot key and the number of salts it needs; ``None`` stands for null keys.

    A key is hot if it holds more rows than an average shuffle partition, so there are at most as many as
    partitions. Reads the key columns once and moves only sketches, whose size follows the partitions and not ``df``.
    """
    spark = df.sparkSession
    partitions = _shuffle_partitions(spark)
    counters = min(MOST_COUNTERS, max(64, COUNTERS_A_PARTITION * partitions))
    sketches = (
        df.select(
            F.when(~_any_null(keys), F.xxhash64(*keys)).alias("key"),
            F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part"),
        )
        .groupBy("part")
        .agg(
            F.expr(f"approx_top_k_accumulate(key, {counters})").alias("sketch"),
            F.count("*").alias("n"),
            F.count("key").alias("n_keys"),
        )
        # Grouped by a constant, as the combination of no sketch at all is an error.
        .groupBy(F.lit("all"))
        .agg(
            F.expr("approx_top_k_combine(sketch)").alias("sketch"),
            F.sum("n").alias("n"),
            F.sum("n_keys").alias("n_keys"),
        )
    )
    found = sketches.select(
        "n", "n_keys", F.expr(f"approx_top_k_estimate(sketch, {min(counters, partitions + 1)})").alias("top")
    ).first()
    if found is None:
        return {}
    counts = {row["item"]: row["count"] for row in found["top"]}
    counts[None] = found["n"] - found["n_keys"]
    return {
        key: math.ceil(count / found["n"] * partitions) + 1
        for key, count in counts.items()
        if count * partitions > found["n"]
    }


def _hashable(dtype: T.DataType) -> bool:
    text = dtype.simpleString()
    return "map<" not in text and "variant" not in text


def _salted_join(
    facts: DataFrame, lookup: DataFrame, keys: list[str], how: str, hot: dict[int | None, int]
) -> DataFrame:
    spark = facts.sparkSession
    null_salts = hot.get(None, 1)
    salted_keys = [(key, salts) for key, salts in hot.items() if key is not None]
    # At most one row for each shuffle partition, see hot_keys.
    salts = F.broadcast(spark.createDataFrame(salted_keys, "_hot bigint, _salts int"))

    def with_salts(df: DataFrame) -> DataFrame:
        return df.withColumn("_hot", F.xxhash64(*keys)).join(salts, "_hot", "left").drop("_hot")

    # A hash of the row spreads rows of a key that lie in one task, the task's number rows that are equal in every
    # column. Unlike a random number, both are the same when a lost task is run again.
    others = [F.col(c) for c in facts.columns if c not in keys and _hashable(facts.schema[c].dataType)]
    spot = F.xxhash64(F.spark_partition_id(), *others)
    salt = (
        F.when(_any_null(keys), F.pmod(spot, F.lit(null_salts)))
        .when(F.col("_salts").isNotNull(), F.pmod(spot, F.col("_salts")))
        .otherwise(F.lit(0))
        .cast("int")
    )
    spread = with_salts(facts).withColumn("_salt", salt).drop("_salts")
    repeated = (
        with_salts(lookup)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return spread.join(repeated, [*keys, "_salt"], how).drop("_salt")


def _may_skew(facts: DataFrame, lookup: DataFrame, how: str) -> bool:
    return not (fits_broadcast(lookup) or (how == "inner" and fits_broadcast(facts)))


def _aligned(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Integer keys of different widths as bigint, so that both sides hash alike; a join compares them so anyway."""
    unlike = [k for k in keys if df.schema[k].dataType != other.schema[k].dataType]
    return df.withColumns({k: F.col(k).cast("bigint") for k in unlike}) if unlike else df


def _alike(facts: DataFrame, lookup: DataFrame, keys: list[str]) -> bool:
    """Whether keys are of one type on both sides, or all that are not are integers."""
    types = [(facts.schema[k].dataType, lookup.schema[k].dataType) for k in keys]
    return all(a == b or (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)) for a, b in types)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on columns named alike on both sides.

    ``facts`` may hold many rows per key and has its hot keys split; ``how`` is
    ``inner``, ``left``, ``left_semi`` or ``left_anti``. Where ``lookup`` also
    repeats keys and only presence counts, reduce it with ``distinct`` before.

    ``keys_from`` is the table to look for hot keys in, for ``facts`` that are the
    result of joins: looking there costs a scan, looking in ``facts`` the joins. The look is a job of
    its own, run when the plan is made, wherever neither side is broadcast. Integer keys may be of different widths; keys of other different types are compared as Spark
    compares them, and not split.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    source = facts if keys_from is None else keys_from
    if not (_may_skew(facts, lookup, how) and _alike(facts, lookup, keys)):
        return facts.join(lookup, keys, how)
    wide = _aligned(facts, lookup, keys)
    hot = hot_keys(_aligned(source, wide, keys), keys)
    if not hot:
        return facts.join(lookup, keys, how)
    joined = _salted_join(wide, _aligned(lookup, wide, keys), keys, how, hot)
    # A key keeps the type that it has among the facts.
    return joined.withColumns({k: F.col(k).cast(facts.schema[k].dataType) for k in keys if wide.schema[k].dataType != facts.schema[k].dataType})


def unreferenced(items: DataFrame, references: DataFrame, on: str) -> DataFrame:
    """Rows of ``items`` whose ``on`` does not occur in ``references``; equal items all stay.

    References are made distinct first: a key repeated many times is folded in
    the tasks that read it, and the join reuses the shuffle of the distinct.
    """
    return lookup_join(items, references.select(on).distinct(), on, "left_anti")
