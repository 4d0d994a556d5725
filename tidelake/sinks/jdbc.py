"""Gold tables in a JDBC warehouse."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: str,
    batch_size: int = 5000,
    connections: int = 16,
) -> None:
    """Append to ``table``, or replace its rows.

    Replacing truncates: dropping the table would lose its keys and column
    lengths. ``connections`` tasks write at once; what computes the rows keeps its own width. Columns are matched
    by name. An append has no key to recognise a repeated day by: append to a staging table that is emptied first, and merge it in the
    database, or load the Parquet warehouse.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode {mode!r}")
    options = {"batchsize": str(batch_size), **properties}
    if mode == "overwrite":
        options["truncate"] = "true"
    # As an option of the writer this number would be the last aggregation's too.
    df.repartition(connections).write.jdbc(url, table, mode=mode, properties=options)
