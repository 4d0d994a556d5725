"""Time between two timestamps as a whole number of seconds or minutes.

Durations stay integers until the last step: integer sums are exact and do not
depend on the order in which tasks finish, sums of fractional hours would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

UNITS_PER_HOUR = {"second": 3600, "minute": 60}


def _epoch_seconds(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        # Counted from year 1, where truncation towards zero is a floor. Going
        # through a zoned timestamp would lose or add an hour at clock changes.
        return F.expr(f"CAST(CAST(`{name}` - TIMESTAMP_NTZ'0001-01-01' AS INTERVAL SECOND) AS BIGINT)")
    return F.unix_seconds(name)


def with_duration(df: DataFrame, start: str, end: str, out: str, resolution: str = "second") -> DataFrame:
    """Add ``out``: the time from ``start`` to ``end`` in units of ``resolution``.

    ``second`` drops the fraction of a second of either side; ``minute`` drops
    what is left of the difference below a full minute. Null if either side is.
    """
    if resolution == "second":
        return df.withColumn(out, _epoch_seconds(df, end) - _epoch_seconds(df, start))
    if resolution == "minute":
        return df.withColumn(out, F.expr(f"CAST(CAST(`{end}` - `{start}` AS INTERVAL MINUTE) AS BIGINT)"))
    raise ValueError(f"resolution must be one of {sorted(UNITS_PER_HOUR)}, not {resolution!r}")
