"""Readers for the four billing tables and mappings of star schemas onto them."""

from ledgerlens.sources.bronze import (
    UpstreamMissing,
    from_rows,
    read_bronze_csv,
    read_labels_csv,
    read_table,
    read_tables,
    require,
)
from ledgerlens.sources.csv_files import MissingColumn, csv_headers
from ledgerlens.sources.mapping import Lookup, MappingError, Rows, StarMapping
from ledgerlens.sources.testdata import billing_tables

__all__ = [
    "Lookup", "MappingError", "MissingColumn", "Rows", "StarMapping", "UpstreamMissing", "billing_tables", "csv_headers", "from_rows",
    "read_bronze_csv", "read_labels_csv", "read_table", "read_tables", "require",
]
