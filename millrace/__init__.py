"""millrace: declare table mappings, run them as Spark jobs, prove nothing was lost."""

from millrace.spec import Latest, Reference, Rule, Surrogate, TableSpec, Unique

__all__ = ["Latest", "Reference", "Rule", "Surrogate", "TableSpec", "Unique"]
