"""Current state and history kept in step with events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import left_lookup
from millrace.operators.merge import insert_ignoring
from millrace.operators.rank import first_per_key, number_rows


def mirror_moves(moves: DataFrame, history: DataFrame, key: str, day: str, place_id: str, place: str) -> DataFrame:
    """History with a row for every move it lacks: same member, day and place (by id or by name).

    Rows that come from moves carry reason 'move'.
    """
    wanted = moves.where(F.col(key).isNotNull()).select(key, day, place_id, place, F.lit("move").alias("reason"))
    by_id = history.select(key, day, place_id).dropna().dropDuplicates()
    by_name = history.select(key, day, place).dropna().dropDuplicates()
    lacking = left_lookup(wanted, by_id, [key, day, place_id], "left_anti")
    lacking = left_lookup(lacking, by_name, [key, day, place], "left_anti")
    fresh = insert_ignoring(lacking, None, [(key, day, place_id)], [F.col(place)])
    return history.unionByName(fresh, allowMissingColumns=True)


def undo_moves(history: DataFrame, undone: DataFrame, key: str, day: str, place_id: str, row_id: str) -> DataFrame:
    """Take back moves: each undone move removes one mirrored row of the same member, day and place."""
    keys = [key, day, place_id]
    counts = undone.groupBy(*keys).agg(F.count(F.lit(1)).alias("_undo"))
    mirrored = history.where(F.col("reason") == "move")
    touched = left_lookup(mirrored, counts, keys, "inner").select(*keys, row_id, "_undo")
    removed = number_rows(touched, [row_id], "_n", within=keys).where(F.col("_n") <= F.col("_undo")).select(row_id)
    # row ids are unique, so the join has no frequent keys
    return left_lookup(history, removed, [row_id], "left_anti", salted=False)


def latest_open(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Per key the open row (no end) if there is one, else the newest start; a missing start counts as newest."""
    return first_per_key(df, [key], [F.col(end).isNotNull().asc(), F.col(start).desc_nulls_first()])


def current_assignments(
    events: DataFrame, member: str, holding: str, status: str, order: Sequence[Column], current: str = "active"
) -> DataFrame:
    """Assignment rows (member, holding, active, reason) after a history of (holding, status) changes of members.

    One row per member and holding it ever held while active. The last event decides: still active with this
    holding -> active; active with another -> 'retag'; no holding -> 'untagged'; else the status itself.
    """
    held = (F.col(status) == current) & F.col(holding).isNotNull() & (F.col(holding).cast("string") != "")
    pairs = events.where(held).select(member, holding).dropDuplicates()
    last = first_per_key(events, [member], order).select(
        member, F.col(holding).alias("_holding"), F.col(status).alias("_status"), held.alias("_held")
    )
    joined = left_lookup(pairs, last, [member], "inner")
    active = F.col("_held") & (F.col("_holding") == F.col(holding))
    reason = (
        F.when(F.col("_held") & ~active, "retag")
        .when(active, F.lit(None))
        .when(F.col("_status") != current, F.col("_status"))
        .otherwise("untagged")
    )
    return joined.select(member, holding, F.coalesce(active, F.lit(False)).alias("active"), reason.alias("reason"))


def cached_counts(parents: DataFrame, key: str, members: DataFrame, foreign_key: str, keep: Column, out: str) -> DataFrame:
    """Members per parent that pass `keep`; parents without any get zero."""
    counts = members.where(keep).groupBy(F.col(foreign_key).alias(key)).agg(F.count(F.lit(1)).alias(out))
    # a parent occurs once, so the join has no frequent keys
    return left_lookup(parents, counts, [key], salted=False).withColumn(out, F.coalesce(out, F.lit(0)))


__all__ = [
    "cached_counts",
    "current_assignments",
    "latest_open",
    "mirror_moves",
    "undo_moves",
]
