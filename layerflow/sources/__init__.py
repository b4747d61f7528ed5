"""Readers for the landing layer and for catalog tables."""

from layerflow.sources.files import (
    LINEAGE_COLUMNS,
    all_string_schema,
    read_csv_strings,
    stage_csv,
    with_lineage,
)
from layerflow.sources.jdbc import jdbc_options, read_jdbc
from layerflow.sources.tables import incremental_read, read_table, source_batch

__all__ = [
    "LINEAGE_COLUMNS", "all_string_schema", "incremental_read", "jdbc_options",
    "read_csv_strings", "read_jdbc", "read_table", "source_batch", "stage_csv", "with_lineage",
]
