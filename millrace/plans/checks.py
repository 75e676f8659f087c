"""Checks of tables, compiled: however many there are, a table is read once for its rules and once for its keys.

Rules on rows become counts of one aggregate for each table. Keys of all tables (unique keys, references, and the keys
references point to) are unpivoted to (check, key) and counted together, so that they share a single shuffle in which a
frequent key is one row a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import canonical_text


@dataclass(frozen=True, eq=False)
class RowCheck:
    """Passes when no row of the table is `failing`."""

    name: str
    table: DataFrame
    failing: Column
    what: str = "failing rows"


@dataclass(frozen=True, eq=False)
class UniqueCheck:
    """Passes when no key is held by two rows that `keep` lets through. A key with a null in it is none."""

    name: str
    table: DataFrame
    keys: tuple[str | Column, ...]
    keep: Column | None = None
    what: str = "duplicate keys"


@dataclass(frozen=True, eq=False)
class ReferenceCheck:
    """Passes when every set reference has a parent."""

    name: str
    table: DataFrame
    column: str
    parent: DataFrame
    key: str
    what: str = "orphaned rows"


Check = RowCheck | UniqueCheck | ReferenceCheck


def _by_table(pairs: Sequence[tuple[DataFrame, object]]) -> list[tuple[DataFrame, list]]:
    """Put together what is asked of the same table."""
    found: dict[int, tuple[DataFrame, list]] = {}
    for df, what in pairs:
        found.setdefault(df.semanticHash(), (df, []))[1].append(what)
    return list(found.values())


def _text(df: DataFrame, key: str | Column) -> Column:
    c = F.col(f"`{key}`") if isinstance(key, str) else key
    return canonical_text(c, df.select(c.alias("c")).schema["c"].dataType).cast("string")


def _row(name: str, n: Column, what: str) -> Column:
    detail = F.concat(F.lit(f"{what}: "), n.cast("string"))
    return F.struct(F.lit(name).alias("check"), (n == 0).alias("passed"), detail.alias("detail"))


def _rule_counts(checks: Sequence[RowCheck]) -> list[DataFrame]:
    out = []
    for df, asked in _by_table([(c.table, c) for c in checks]):
        counts = df.agg(*[F.count_if(c.failing).alias(f"n{i}") for i, c in enumerate(asked)])
        out.append(counts.select(F.inline(F.array(*[_row(c.name, F.col(f"n{i}"), c.what) for i, c in enumerate(asked)]))))
    return out


def _key_counts(checks: Sequence[UniqueCheck | ReferenceCheck]) -> DataFrame:
    asked: list[tuple[DataFrame, tuple]] = []
    for i, c in enumerate(checks):
        if isinstance(c, UniqueCheck):
            parts = [_text(c.table, k) for k in c.keys]
            whole = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
            whole = whole if c.keep is None else whole & F.coalesce(c.keep, F.lit(False))
            asked.append((c.table, (i, F.when(whole, F.to_json(F.array(*parts)) if len(parts) > 1 else parts[0]), False)))
        else:
            asked.append((c.table, (i, _text(c.table, c.column), False)))
            asked.append((c.parent, (i, _text(c.parent, c.key), True)))
    cells = []
    for df, wanted in _by_table(asked):
        each = [F.struct(F.lit(i).alias("c"), key.alias("k"), F.lit(parent).alias("parent")) for i, key, parent in wanted]
        cells.append(df.select(F.inline(F.array(*each))).where("k IS NOT NULL"))
    held = F.sum(F.when(F.col("parent"), 0).otherwise(1)).alias("n")
    keys = reduce(DataFrame.union, cells).groupBy("c", "k").agg(held, F.bool_or("parent").alias("known"))
    totals, out = [], []
    for i, c in enumerate(checks):
        own = F.col("c") == i
        unique = isinstance(c, UniqueCheck)
        n = F.count_if(own & (F.col("n") > 1)) if unique else F.coalesce(F.sum(F.when(own & ~F.col("known"), F.col("n"))), F.lit(0))
        totals.append(n.alias(f"n{i}"))
        out.append(_row(c.name, F.col(f"n{i}"), c.what))
    return keys.agg(*totals).select(F.inline(F.array(*out)))


def compiled(checks: Sequence[Check]) -> DataFrame:
    """(check, passed, detail), a row for each check."""
    rules = [c for c in checks if isinstance(c, RowCheck)]
    keys = [c for c in checks if not isinstance(c, RowCheck)]
    return reduce(DataFrame.union, [*_rule_counts(rules), *([_key_counts(keys)] if keys else [])])
