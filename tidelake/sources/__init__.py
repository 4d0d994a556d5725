"""Readers: bronze and silver files, and relational tables."""

from tidelake.sources.files import (
    DAY_FILES,
    DAY_FOLDERS,
    bronze_path,
    bronze_paths,
    date_range,
    day_slice,
    read_bronze_csv,
    read_bronze_json,
    read_silver,
)
from tidelake.sources.jdbc import extract_table, jdbc_bounds, list_tables, read_table

__all__ = [
    "DAY_FILES",
    "DAY_FOLDERS",
    "bronze_path",
    "bronze_paths",
    "date_range",
    "day_slice",
    "extract_table",
    "jdbc_bounds",
    "list_tables",
    "read_bronze_csv",
    "read_bronze_json",
    "read_silver",
    "read_table",
]
