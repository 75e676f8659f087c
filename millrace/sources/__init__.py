from millrace.sources.declared import declared_schemas, read_declared
from millrace.sources.raw import capture_raw, capture_raw_tables
from millrace.sources.readers import (
    ParquetSource,
    JdbcSource,
    database_group,
    project_tolerant,
    schema_presence,
    unite_farms,
)
from millrace.sources.sinks import TargetStore, by_year
from millrace.sources.views import register_views

__all__ = [
    "JdbcSource",
    "ParquetSource",
    "TargetStore",
    "by_year",
    "capture_raw",
    "capture_raw_tables",
    "database_group",
    "declared_schemas",
    "project_tolerant",
    "read_declared",
    "register_views",
    "schema_presence",
    "unite_farms",
]
