"""Writers: files, the warehouse tables, and a JDBC warehouse."""

from tidelake.sinks.files import write_csv, write_json, write_table
from tidelake.sinks.jdbc import write_jdbc
from tidelake.sinks.warehouse import (
    create_star_schema,
    find_violations,
    load_dimension,
    load_fact,
)

__all__ = [
    "create_star_schema",
    "find_violations",
    "load_dimension",
    "load_fact",
    "write_csv",
    "write_jdbc",
    "write_json",
    "write_table",
]
