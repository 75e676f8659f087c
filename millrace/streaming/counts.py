"""Member counts per parent kept up to date from a stream of membership changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def running_counts(changes: DataFrame, parent: str, joins: Column, leaves: Column, out: str = "members") -> DataFrame:
    """Parent -> members so far. Written in update mode, each batch gives the parents whose count changed.

    State is one number per parent, not one per member.
    """
    step = F.when(joins, F.lit(1)).when(leaves, F.lit(-1)).otherwise(F.lit(0))
    return changes.where(F.col(parent).isNotNull()).groupBy(parent).agg(F.sum(step).alias(out))
