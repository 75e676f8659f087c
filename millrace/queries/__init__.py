"""Every operator as a query over the driver's tables, with the SQL that must give the same rows."""

from millrace.queries.registry import QUERIES, SQL
from millrace.queries import (  # noqa: F401  (registers the queries)
    aggregates,
    cells,
    joins,
    projections,
    reports,
    shapes,
    sources,
    windows,
)

__all__ = ["QUERIES", "SQL"]
