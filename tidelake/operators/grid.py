"""Every combination of request parameters."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def request_grid(
    first: DataFrame, others: Mapping[str, Sequence | DataFrame], allowed: Collection[str]
) -> DataFrame:
    """One row per combination of the one-column frame ``first`` and the lists, or one-column frames, in ``others``.

    Lists are call arguments, so they are exploded in place: no join and no shuffle. A frame's
    distinct values are gathered into one list first, so it holds parameters, not data. Each row has the landing folder and file name of its answer. A
    parameter the endpoint does not know is an error.
    """
    names = [*first.columns, *others]
    unknown = [name for name in names if name not in allowed]
    if unknown:
        raise ValueError(f"parameters not allowed: {', '.join(unknown)}")
    grid = first
    for name, values in others.items():
        if isinstance(values, DataFrame):
            listed = values.agg(F.array_sort(F.collect_set(values.columns[0]))).scalar()
        else:
            listed = F.array(*[F.lit(v) for v in values])
        grid = grid.withColumn(name, F.explode(listed))
    texts = [F.col(name).cast("string") for name in names]
    return grid.withColumn("folder", texts[0]).withColumn("file_name", F.concat_ws("+", *texts))
