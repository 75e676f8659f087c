"""Reshaping: wide slots to rows, flat steps to headers and steps, two-way column filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import left_lookup
from millrace.operators.resolve import having


def unpivot_slots(
    df: DataFrame, key: str | Sequence[str], slots: Mapping[str, int], slot_as: str = "slot", value_as: str = "value"
) -> DataFrame:
    """One row per filled slot; `slots` maps column -> slot number and absent columns are passed over."""
    keys = [key] if isinstance(key, str) else list(key)
    by_lower = {c.lower(): c for c in df.columns}
    present = {by_lower[c.lower()]: n for c, n in slots.items() if c.lower() in by_lower}
    cells = F.array(
        *[F.struct(F.lit(n).alias(slot_as), F.col(f"`{c}`").try_cast("double").alias(value_as)) for c, n in present.items()]
    )
    long = df.select(*keys, F.explode(cells).alias("_cell")).select(*keys, f"_cell.{slot_as}", f"_cell.{value_as}")
    return long.where(F.col(value_as).isNotNull())


def numbered_columns(pattern: str, first: int, last: int) -> dict[str, int]:
    """{'DATA0': 0, ...} from 'DATA{}'."""
    return {pattern.format(n): n for n in range(first, last + 1)}


def fill_both_ways(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Keep an old and a new column equal: each is filled from the other where it is null."""
    filled = {}
    for old, new in pairs.items():
        filled[old] = F.coalesce(F.col(old), F.col(new))
        filled[new] = F.coalesce(F.col(new), F.col(old))
    return df.withColumns(filled)


def step_day(day: Column) -> Column:
    """Day numbers of the source start at 1, those of the target at 0."""
    return F.greatest(F.coalesce(day, F.lit(1)) - 1, F.lit(0))


def split_header_steps(
    rows: DataFrame,
    parents: DataFrame,
    items: DataFrame,
    existing: DataFrame | None = None,
    parent_legacy: str = "disease_id",
    parent_name: str = "disease_name",
    item_legacy: str = "drug_id",
    scope: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split flat step rows (parent, day, item, dose, by_weight) into headers, steps and rows left as they are.

    Each parent found by its legacy id gets one header, unless `existing` already holds one for it; its rows
    become steps of that header. Rows whose parent is unknown are handed back. Legacy ids hold within `scope`.
    """
    scope = list(scope)
    parent = parents.where(F.col(parent_legacy).isNotNull()).groupBy(*scope, F.col(parent_legacy).alias("_legacy"))
    parent = parent.agg(F.max(F.struct(F.col("id").alias("parent_id"), F.trim(F.col(parent_name)).alias("name"))).alias("_p"))
    parent = parent.select(*scope, "_legacy", "_p.*")
    joined = left_lookup(rows.withColumn("_legacy", F.col("parent")), parent, [*scope, "_legacy"]).drop("_legacy")
    unmatched = joined.where(F.col("parent_id").isNull()).drop("parent_id", "name")
    matched = joined.where(F.col("parent_id").isNotNull())
    headers = matched.groupBy(*scope, "parent_id").agg(
        F.max("name").alias("name"),
        F.max("day").alias("days"),
        F.bool_or(F.coalesce("by_weight", F.lit(False))).alias("by_weight"),
    )
    if existing is not None:
        headers = having(headers, "parent_id", existing, "parent_id", present=False)
    item_ids = items.where(F.col(item_legacy).isNotNull()).groupBy(*scope, F.col(item_legacy).alias("_key"))
    item_ids = item_ids.agg(F.max("id").alias("item_id"))
    keys = rows.withColumn("_key", F.col("item"))
    steps = left_lookup(matched.withColumn("_key", F.col("item")), item_ids, [*scope, "_key"], keys_from=keys)
    return headers, steps.select(*scope, "parent_id", step_day(F.col("day")).alias("day_number"), "item_id", "dose"), unmatched
