"""Relational building blocks: DataFrames in, a lazy DataFrame out."""

from tidelake.operators.grid import request_grid
from tidelake.operators.quality import (
    check_max_length,
    check_not_null,
    check_unique_key,
    clean,
)
from tidelake.operators.ranking import dense_ranks, top1_per_class, top_k, top_n_dense
from tidelake.operators.rollup import roll_up, totals
from tidelake.operators.skew import hot_keys, lookup_join, unreferenced
from tidelake.operators.wide import distinct_rows

__all__ = [
    "check_max_length",
    "check_not_null",
    "check_unique_key",
    "clean",
    "dense_ranks",
    "distinct_rows",
    "hot_keys",
    "lookup_join",
    "request_grid",
    "roll_up",
    "top1_per_class",
    "top_k",
    "top_n_dense",
    "totals",
    "unreferenced",
]
