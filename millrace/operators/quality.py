"""Measures of a table: counts, null rates, ranges, duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import to_timestamp


def count_rows(df: DataFrame, distinct: Sequence[str] = ()) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), *[F.countDistinct(c).alias(f"distinct_{c}") for c in distinct]
    )


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count, row_count, null_pct) for all columns from one pass over the table."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_all"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    cells = F.array(*[F.struct(F.lit(c).alias("n"), F.col(f"_{i}").alias("f")) for i, c in enumerate(columns)])
    long = counts.select("_all", F.explode(cells).alias("_c"))
    nulls = F.col("_all") - F.col("_c.f")
    return long.select(
        F.col("_c.n").alias("column_name"),
        nulls.alias("null_count"),
        F.col("_all").alias("row_count"),
        F.round(F.when(F.col("_all") > 0, nulls * 100.0 / F.col("_all")), 1).alias("null_pct"),
    )


def date_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, min_date, max_date) from one pass; text is read as a date first, and what is none is passed over."""
    dates = {c: to_timestamp(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns}
    ends = df.agg(*[f(dates[c]).alias(f"{n}{i}") for i, c in enumerate(columns) for f, n in ((F.min, "a"), (F.max, "z"))])
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"a{i}").alias("min_date"), F.col(f"z{i}").alias("max_date"))
            for i, c in enumerate(columns)
        ]
    )
    return ends.select(F.inline(cells))


def duplicate_groups(df: DataFrame, keys: Sequence[str | Column], keep: Column | None = None, **more: Column) -> DataFrame:
    """Keys held more than once, with their row count and `more` aggregates. Null keys do not count."""
    rows = df if keep is None else df.where(keep)
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    names = rows.select(*named).columns
    grouped = (rows.withColumns(dict(zip(names, named, strict=True))) if more else rows.select(*named)).dropna(subset=names).groupBy(*names)
    return grouped.agg(F.count(F.lit(1)).alias("row_count"), *(c.alias(n) for n, c in more.items())).where(F.col("row_count") > 1)


def duplicate_summary(groups: DataFrame) -> DataFrame:
    return groups.agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("excess_rows"),
    )


def filtered_counts(df: DataFrame, tests: dict[str, Column], **more: Column) -> DataFrame:
    """One row: how many rows pass each test, and `more` aggregates of the same scan."""
    return df.agg(*[F.count_if(test).alias(name) for name, test in tests.items()], *(c.alias(n) for n, c in more.items()))


def stranded_columns(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Renamed columns whose data stayed behind: the old one has values and the new one none."""
    present = [(o, n) for o, n in pairs if o in df.columns and n in df.columns]
    spark = df.sparkSession
    if not present:
        return spark.createDataFrame([], "old_column string, new_column string, old_filled long, new_filled long, stranded boolean")
    names = sorted({c for pair in present for c in pair})
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in names])
    cells = F.array(
        *[
            F.struct(
                F.lit(o).alias("old_column"),
                F.lit(n).alias("new_column"),
                F.col(f"`{o}`").alias("old_filled"),
                F.col(f"`{n}`").alias("new_filled"),
                ((F.col(f"`{o}`") > 0) & (F.col(f"`{n}`") == 0)).alias("stranded"),
            )
            for o, n in present
        ]
    )
    return counts.select(F.inline(cells))


def fill_ratio(df: DataFrame, keep: Column, filled: Column) -> DataFrame:
    """How many of the kept rows have a value, and the check the reports use: more than half, or any at all."""
    out = df.agg(
        F.count_if(keep).alias("kept_rows"),
        F.count_if(keep & filled.isNotNull()).alias("filled_rows"),
        F.countDistinct(F.when(keep, filled)).alias("distinct_values"),
    )
    ratio = F.when(F.col("kept_rows") > 0, F.col("filled_rows") / F.col("kept_rows")).otherwise(F.lit(0.0))
    passed = (F.col("kept_rows") == 0) | (F.col("filled_rows") > 0)
    return out.withColumn("fill_ratio", F.round(ratio, 4)).withColumn("passed", passed)
