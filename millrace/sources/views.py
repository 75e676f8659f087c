"""Views that keep old table names alive."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def register_views(frames: Mapping[str, DataFrame], renames: Mapping[str, Mapping[str, str]] | None = None) -> list[str]:
    """Register each frame under its old name; `renames` gives, per view, new column -> old column."""
    renames = renames or {}
    for name, df in frames.items():
        columns = renames.get(name)
        view = df if columns is None else df.select(*[F.col(c).alias(old) for c, old in columns.items()])
        view.createOrReplaceTempView(name)
    return list(frames)
