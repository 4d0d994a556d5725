"""Summed measures moved along foreign keys, added up before every join.

Joining first and grouping last would carry every fact row through each join and,
where two tables repeat a key, multiply them. Here the rows of a key are summed
before before they meet the next table, so a shuffle carries one row per key and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidelake.operators.skew import fits_broadcast, lookup_join


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def totals(df: DataFrame, by: str | Sequence[str], values: str | Sequence[str]) -> DataFrame:
    """Sum of each of ``values`` per ``by``."""
    return df.groupBy(*_names(by)).agg(*[F.sum(v).alias(v) for v in _names(values)])


def roll_up(
    measures: DataFrame,
    links: DataFrame,
    on: str,
    to: str | Sequence[str],
    values: str | Sequence[str],
    carry: str | Sequence[str] = (),
    to_one: bool = False,
) -> DataFrame:
    """Sum ``values`` per ``on`` and hand each sum to the ``to`` columns it is linked with.

    A key linked to several targets counts for each of them; a key without a
    link drops out. ``carry`` are further columns of ``measures`` to keep apart.
    Several rows may share a target: the next step, or a last ``totals``, adds them.
    ``to_one`` promises one target per key. Then no key is hot among the links, and
    links small enough to be broadcast are joined to the measures as they are, which
    saves the shuffle by ``on``.
    """
    to, values, carry = _names(to), _names(values), _names(carry)
    targets = links.select(on, *[c for c in to if c != on])
    if to_one and fits_broadcast(targets):
        linked = measures.join(targets, on)
    elif to_one:
        linked = targets.join(totals(measures, [on, *carry], values), on)
    else:
        linked = lookup_join(targets, totals(measures, [on, *carry], values), on)
    return linked.select(*to, *carry, *values)
