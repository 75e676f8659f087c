"""Replacing legacy ids and names by the new keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import lower_name, upper_name
from millrace.operators.joins import left_lookup, lookup_columns
from millrace.operators.rank import number_rows


def lookup(df: DataFrame, key: str | Column, value: str | Column, key_as: str = "_key", value_as: str = "_value") -> DataFrame:
    """One value per key: the largest, so that the choice does not depend on row order. Null keys are left out."""
    key = F.col(key) if isinstance(key, str) else key
    value = F.col(value) if isinstance(value, str) else value
    return (
        df.select(key.alias(key_as), value.alias(value_as))
        .where(F.col(key_as).isNotNull())
        .groupBy(key_as)
        .agg(F.max(value_as).alias(value_as))
    )


def remap(df: DataFrame, column: str, mapping: DataFrame, into: str | None = None, key: Column | None = None) -> DataFrame:
    """Write the value that `mapping` (_key, _value) holds for `column` into `into`; null where there is none."""
    into = into or column
    keyed = df.withColumn("_key", F.col(column) if key is None else key)
    joined = left_lookup(keyed, mapping, ["_key"])
    return joined.withColumn(into, F.col("_value")).drop("_key", "_value")


def remap_by_name(df: DataFrame, column: str, names: DataFrame, name: str, value: str, into: str) -> DataFrame:
    """As `remap`, on trimmed upper-case names."""
    return remap(df, column, lookup(names, upper_name(F.col(name)), value), into, upper_name(F.col(column)))


def chain(codes: DataFrame, code: str, label: str, named: DataFrame, name: str, value: str) -> DataFrame:
    """code -> label -> value as one mapping (_key, _value); labels meet names trimmed and lower-case."""
    by_name = lookup(named, lower_name(F.col(name)), value, "_name", "_value")
    coded = lookup(codes, code, lower_name(F.col(label)), "_key", "_name")
    return left_lookup(coded, by_name, ["_name"], "inner").select("_key", "_value")


def null_unknown(df: DataFrame, columns: Sequence[str], ids: DataFrame, id_column: str) -> DataFrame:
    """Null the listed references that are not among the ids."""
    known = ids.select(F.col(id_column).alias("_key")).dropna().dropDuplicates().withColumn("_value", F.lit(True))
    found = lookup_columns(df, [(known, {f"_known_{c}": F.col(c) for c in columns})])
    kept = found.withColumns({c: F.when(F.col(f"_known_{c}"), F.col(c)) for c in columns})
    return kept.drop(*[f"_known_{c}" for c in columns])


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference is set but absent from the parent."""
    known = parent.select(F.col(key).alias("_key")).dropna().dropDuplicates()
    marked = child.where(F.col(foreign_key).isNotNull()).withColumn("_key", F.col(foreign_key))
    return left_lookup(marked, known, ["_key"], "left_anti").drop("_key")


def having(parent: DataFrame, key: str, child: DataFrame, foreign_key: str, present: bool = True) -> DataFrame:
    """Parents that have (or have no) child."""
    held = child.select(F.col(foreign_key).alias(key)).dropna().dropDuplicates()
    return parent.join(held, key, "left_semi" if present else "left_anti")


def missing_parents(
    facts: DataFrame,
    reference: Column,
    parents: DataFrame,
    name: str,
    id_column: str,
    normalise=upper_name,
    scope: Sequence[str] = (),
) -> DataFrame:
    """New parent rows (name, id) for names that facts refer to and no parent has, numbered after the largest id.

    Names are told apart within `scope` (the farm, in a run over several).
    """
    wanted = facts.select(*scope, reference.alias(name)).where(normalise(F.col(name)).isNotNull())
    wanted = wanted.withColumn("_norm", normalise(F.col(name))).groupBy(*scope, "_norm").agg(F.min(name).alias(name))
    have = parents.select(*scope, normalise(F.col(name)).alias("_norm")).dropna().dropDuplicates()
    absent = wanted.join(have, [*scope, "_norm"], "left_anti").select(*scope, name)
    highest = parents.agg(F.max(id_column)).first()[0] or 0
    return number_rows(absent, [*scope, name], id_column, highest)


def fill_nulls(target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fill only null cells of `target` from `updates` (one row per key)."""
    renamed = updates.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = left_lookup(target, renamed, [key])
    filled = {c: F.coalesce(F.col(c), F.col(f"_new_{c}")) for c in columns}
    return joined.select(*[filled.get(c, F.col(f"`{c}`")).alias(c) for c in target.columns])


def converge_keys(df: DataFrame, column: str, parents: DataFrame, id_column: str, legacy: str) -> DataFrame:
    """Bring a column that mixes new and legacy keys to new keys only.

    A value that is a new key stays; else a legacy key becomes its new key; anything else becomes null.
    """
    valid = parents.select(F.col(id_column).alias("_key")).dropna().dropDuplicates().withColumn("_valid", F.lit(True))
    mapped = lookup(parents, legacy, id_column)
    both = valid.join(mapped, "_key", "full")
    joined = left_lookup(df.withColumn("_key", F.col(column)), both, ["_key"])
    settled = F.when(F.col("_valid"), F.col("_key")).otherwise(F.col("_value"))
    return joined.withColumn(column, settled).drop("_key", "_valid", "_value")


def unresolved_sample(df: DataFrame, column: str, known: DataFrame, key: str, size: int) -> DataFrame:
    """The first `size` distinct values that do not resolve: a report, not a load."""
    return orphans(df, column, known, key).select(column).distinct().orderBy(column).limit(size)
