"""Materialisations (append, overwrite, insert_overwrite, merge)."""

from hypeline.sinks.tables import (
    append,
    assert_unique,
    insert_overwrite,
    materialize_table,
    merge_upsert,
    overwrite,
    read_table,
    table_built,
    table_exists,
    write,
)

__all__ = ["append", "assert_unique", "insert_overwrite", "materialize_table",
           "merge_upsert", "overwrite", "read_table", "table_built", "table_exists", "write"]
