"""Sources (raw tables, test-data adapter) and sinks (written layers)."""

from revlens.sources.raw import RAW_NAMES, RawTables, read_raw
from revlens.sources.sinks import materialize, read_table, shared_dir, write_table
from revlens.sources.testdata import TestDataSource, raw_tables

__all__ = [
    "RAW_NAMES",
    "RawTables",
    "TestDataSource",
    "materialize",
    "raw_tables",
    "read_raw",
    "read_table",
    "shared_dir",
    "write_table",
]
