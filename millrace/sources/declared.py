"""What targets are declared to hold, as databases list it in information_schema.columns.

A declared target decides how its columns are read, on every farm alike, and which of them must be set. The list is data:
it is read from the target's own database or from a table of the same columns.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Words that types begin with.
WHOLE = {"smallint": T.ShortType(), "tinyint": T.ShortType(), "int": T.IntegerType(), "integer": T.IntegerType(), "serial": T.IntegerType()}
WHOLE |= {"bigint": T.LongType(), "bigserial": T.LongType()}
TYPES = {
    **WHOLE,
    **dict.fromkeys(("boolean", "bool", "bit"), T.BooleanType()),
    **dict.fromkeys(("real", "float", "double", "money", "smallmoney"), T.DoubleType()),
    **dict.fromkeys(("bytea", "binary", "varbinary", "image", "blob"), T.BinaryType()),
    **dict.fromkeys(("timestamp", "datetime", "datetime2", "smalldatetime"), T.TimestampType()),
    "date": T.DateType(),
}


def declared_type(name: str, precision: int | None = None, scale: int | None = None) -> tuple[T.DataType, dict]:
    """Spark's type for a database's, and what else there is to say of it."""
    word = re.match(r"[a-z0-9]*", name.strip().lower())[0]
    if word in ("numeric", "decimal"):
        return (T.DecimalType(precision, scale or 0) if precision and precision <= 38 else T.DoubleType()), {}
    if word == "time":
        return T.StringType(), {"kind": "time"}
    return TYPES.get(word, T.StringType()), {}


def declared_schemas(columns: DataFrame) -> dict[str, T.StructType]:
    """Target -> its columns, from rows (table_name, column_name, data_type) and, where present, table_schema,
    ordinal_position, numeric_precision, numeric_scale and is_nullable. A row for each declared column, not for data.
    """
    have = {c.lower(): c for c in columns.columns}
    known = ("table_schema", "table_name", "column_name", "data_type", "ordinal_position", "numeric_precision", "numeric_scale", "is_nullable")
    rows = [dict(zip([n for n in known if n in have], r, strict=True)) for r in columns.select(*(have[n] for n in known if n in have)).collect()]
    out: dict[str, list[tuple]] = {}
    for r in rows:
        target = ".".join(x for x in (r.get("table_schema"), r["table_name"]) if x)
        kind, said = declared_type(r["data_type"], r.get("numeric_precision"), r.get("numeric_scale"))
        f = T.StructField(r["column_name"], kind, str(r.get("is_nullable", "YES")).upper() != "NO", said)
        out.setdefault(target, []).append((r.get("ordinal_position") or 0, len(out.get(target, ())), f))
    return {target: T.StructType([f for _, _, f in sorted(fields, key=lambda x: x[:2])]) for target, fields in out.items()}


def read_declared(source, group: str = "main") -> dict[str, T.StructType]:
    """The declared schemas of a database; empty where it does not list them."""
    columns = source.read("information_schema.columns", group)
    return {} if columns is None else declared_schemas(columns)
