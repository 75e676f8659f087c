"""Catch-all capture: any row of any table as JSON."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"}


def row_struct(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The row as one struct, ready for JSON; binary cells are replaced by their size."""
    chosen = []
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BinaryType):
            c = F.when(c.isNotNull(), F.concat(F.lit("[BINARY "), F.octet_length(c).cast("string"), F.lit(" bytes]")))
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = c.cast("timestamp")
        chosen.append(c.alias(f.name))
    return F.struct(*chosen)


def row_json(row: Column) -> Column:
    """JSON of a row struct, nulls kept."""
    return F.to_json(row, JSON_OPTIONS)


def capture_raw(df: DataFrame, source_table: str) -> DataFrame:
    return df.select(F.lit(source_table).alias("source_table"), row_json(row_struct(df)).alias("row_data"))


def capture_raw_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [capture_raw(df, name) for name, df in tables.items()])
