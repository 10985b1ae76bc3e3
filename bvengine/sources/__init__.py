"""Sources: declared schemas and checked loaders (Parquet or catalog tables)."""

from .loader import DRIVER_TABLES, DomainTables, SchemaError, conform, load, read_table
from .sink import write_bucketed, write_worklist
from .schemas import DOMAIN_SCHEMAS, OUTPUT_COLUMNS, OUTPUT_SCHEMA

__all__ = [
    "DOMAIN_SCHEMAS",
    "DRIVER_TABLES",
    "DomainTables",
    "OUTPUT_COLUMNS",
    "OUTPUT_SCHEMA",
    "SchemaError",
    "conform",
    "load",
    "read_table",
    "write_bucketed",
    "write_worklist",
]
