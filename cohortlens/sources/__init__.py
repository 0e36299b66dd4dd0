"""Table sources and sinks."""

from .readers import load_tables, read_csv, read_jdbc, read_table
from .writers import write_csv, write_ranked, write_table

__all__ = [
    "load_tables", "read_csv", "read_jdbc", "read_table",
    "write_csv", "write_ranked", "write_table",
]
