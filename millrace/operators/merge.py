"""Combining rows with a target that already has some."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.components import connected
from millrace.operators.joins import left_lookup
from millrace.operators.rank import first_per_key, flag_first, number_rows, row_hash
from millrace.session import stored

#: Rows of one component that a task holds at most.
COMPONENT_ROWS = 100_000

# the columns of a unique key, and a condition rows must meet to be held to it
UniqueKey = tuple[tuple[str, ...], str | None]


def _plain(unique: UniqueKey | Sequence[str]) -> UniqueKey:
    parts, where = unique if isinstance(unique[0], (tuple, list)) else (unique, None)
    return tuple(parts), where


def _key_parts(df: DataFrame, uniques: Sequence[UniqueKey], keep: Column | None = None) -> tuple[DataFrame, list[str]]:
    """One text column per unique key; null where the key does not bind, as nulls never conflict."""
    names = []
    for i, (parts, where) in enumerate(uniques):
        binds = reduce(lambda a, b: a & b, [F.expr(p).isNotNull() for p in parts])
        if where is not None:
            binds = binds & F.expr(where)
        if keep is not None:
            binds = binds & keep
        key = F.to_json(F.array(*[F.expr(p).cast("string") for p in parts]))
        df = df.withColumn(f"_key{i}", F.when(binds, key))
        names.append(f"_key{i}")
    return df, names


def mark_conflicts(
    batch: DataFrame,
    target: DataFrame | None,
    uniques: Sequence[UniqueKey | Sequence[str]],
    order: Sequence[Column],
    flag: str = "_conflict",
    keep: Column | None = None,
    most: int = COMPONENT_ROWS,
) -> DataFrame:
    """Mark batch rows an insert that ignores conflicts would not insert. Rows outside `keep` take no part.

    The target's rows win, then the earliest accepted row of the batch. A rejected row blocks nobody, so with
    several unique keys rows are settled by the components that their keys make of them.
    """
    uniques = [_plain(u) for u in uniques]
    keyed, keys = _key_parts(batch, uniques, keep)
    keyed = keyed.withColumn(flag, F.lit(False))
    if target is not None:
        held, _ = _key_parts(target, uniques)
        for key in keys:
            taken = held.select(key).dropna().dropDuplicates().withColumn("_taken", F.lit(True))
            keyed = left_lookup(keyed, taken, [key])
            keyed = keyed.withColumn(flag, F.col(flag) | F.coalesce("_taken", F.lit(False))).drop("_taken")
    if len(keys) == 1:
        # rejected rows sort last, so the first row of a key is an accepted one if there is any
        firsts = flag_first(keyed, keys, [F.col(flag).asc(), *order], "_first")
        return firsts.withColumn(flag, F.col(flag) | ~F.col("_first")).drop("_first", *keys)
    return _settle(keyed, keys, order, flag, most)


def _settle(keyed: DataFrame, keys: list[str], order: Sequence[Column], flag: str, most: int) -> DataFrame:
    """Several unique keys: rows are numbered in order of arrival and written down once; the rest works on numbers alone.

    A key that several undecided rows hold is named by the first of them. Rows that hold no such key are in.
    """
    fixed = number_rows(keyed, order, "_row").withColumnRenamed(flag, "_lost")
    open_rows = fixed.where("NOT _lost").select("_row", *keys)
    leads = [f"_lead{key}" for key in keys]
    # one row for each key that a row holds, so that all keys are counted, looked up and put together at once
    cells = F.array(*[F.concat(F.lit(f"{i} "), key) for i, key in enumerate(keys)])
    held = open_rows.select("_row", F.posexplode(cells).alias("_at", "_held")).where(F.col("_held").isNotNull())
    shared = held.groupBy("_held").agg(F.min("_row").alias("_lead"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    named = left_lookup(held, shared, ["_held"], "inner")
    contested = named.groupBy("_row").agg(*[F.max(F.when(F.col("_at") == i, F.col("_lead"))).alias(lead) for i, lead in enumerate(leads)])
    rejected = _rejected(stored(contested), leads, most)
    marked = fixed.join(rejected.withColumn("_out", F.lit(True)), "_row", "left")
    return marked.withColumn(flag, F.col("_lost") | F.coalesce("_out", F.lit(False))).drop("_row", "_lost", "_out", *keys)


def _rejected(rows: DataFrame, leads: list[str], most: int) -> DataFrame:
    """(_row) of the rows (_row, leads...) that are not inserted: a row is in unless one before it that is in shares a lead.

    First, rows that come first under all their leads are in, and rows that share one with them are out; that decides all
    but chains. What is left falls into components. Those of at most `most` rows are gone through in order, many in a task,
    each held alone; larger ones take another such round, which breaks them up.
    """
    out = []
    while True:
        first = reduce(lambda a, b: a & b, [F.col(c).isNull() | (F.col(c) == F.col("_row")) for c in leads])
        accepted = rows.where(first).select("_row")
        rest = rows.where(~first)
        lost = F.lit(False)
        for c in leads:
            taken = accepted.select(F.col("_row").alias(c), F.lit(True).alias(f"_taken{c}"))
            rest = left_lookup(rest, taken, [c])
            lost = lost | F.coalesce(f"_taken{c}", F.lit(False))
        decided = stored(rest.select("_row", *leads, lost.alias("_lost")))
        out.append(decided.where("_lost").select("_row"))
        left = decided.where("NOT _lost").drop("_lost")
        count = left.count()
        if not count:
            break
        if count <= most:
            out.append(stored(left.withColumn("root", F.lit(0)).coalesce(1).sortWithinPartitions("_row").mapInArrow(_in_order(leads), "_row long")))
            break
        # a lead that is out hands its name on to nobody: the rest of its key keeps it as a mere name
        pairs = reduce(DataFrame.union, [left.where(F.col(c).isNotNull()).select(F.col("_row").alias("a"), F.col(c).alias("b")) for c in leads])
        roots = connected(pairs)
        sizes = roots.groupBy("root").count()
        grouped = left_lookup(left.join(roots.withColumnRenamed("node", "_row"), "_row"), sizes, ["root"])
        small = grouped.where(F.col("count") <= most).select("root", "_row", *leads)
        ordered = small.repartition("root").sortWithinPartitions("root", "_row")
        out.append(stored(ordered.mapInArrow(_in_order(leads), "_row long")))
        large = grouped.where(F.col("count") > most).select("_row", *leads)
        if large.isEmpty():
            break
        rows = large.select("_row")
        for c in leads:
            again = large.groupBy(c).agg(F.min("_row").alias("_least"), F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) & F.col(c).isNotNull())
            named = left_lookup(large.select("_row", c), again, [c]).select("_row", F.col("_least").alias(c))
            rows = rows.join(named, "_row")
        rows = stored(rows)
    return reduce(DataFrame.union, out)


def _in_order(leads: Sequence[str]):
    """Goes through the rows of each component in order of arrival and gives those that find a key taken."""

    def run(batches):
        now, taken = None, set()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("root", "_row", *leads)]
            lost = []
            for root, row, *names in zip(*columns, strict=True):
                if root != now:
                    now, taken = root, set()
                held = [(i, name) for i, name in enumerate(names) if name is not None]
                if any(key in taken for key in held):
                    lost.append(row)
                else:
                    taken.update(held)
            yield pa.RecordBatch.from_arrays([pa.array(lost, pa.int64())], names=["_row"])

    return run


def insert_ignoring(batch: DataFrame, target: DataFrame | None, uniques: Sequence[UniqueKey | Sequence[str]], order: Sequence[Column]) -> DataFrame:
    """The batch rows that an insert ignoring conflicts adds.

    With one unique key only each task's first row per key is shuffled.
    """
    if len(uniques) > 1:
        return mark_conflicts(batch, target, uniques, order).where("NOT _conflict").drop("_conflict")
    parts, where = _plain(uniques[0])
    if where is not None or any("(" in p for p in parts):
        return mark_conflicts(batch, target, uniques, order).where("NOT _conflict").drop("_conflict")
    parts = list(parts)
    free = batch
    if target is not None:
        taken = target.select(*parts).dropna().dropDuplicates()
        free = left_lookup(batch, taken, parts, "left_anti")
    full = reduce(lambda a, b: a & b, [F.col(p).isNotNull() for p in parts])
    return first_per_key(free.where(full), parts, order).unionByName(free.where(~full))


def upsert(existing: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Updates replace existing rows of the same key as a whole; the rest stays. `order` picks among several updates."""
    if order is not None:
        updates = first_per_key(updates, keys, order)
    fresh = updates.select(*[F.col(k) for k in keys], F.lit(True).alias("_fresh"), F.struct(*updates.columns).alias("_new"))
    joined = existing.withColumn("_old", F.struct(*existing.columns)).select(*keys, "_old").join(fresh, list(keys), "full")
    return joined.select(
        *[F.when(F.col("_fresh"), F.col(f"_new.`{c}`")).otherwise(F.col(f"_old.`{c}`")).alias(c) for c in existing.columns]
    )


def consolidate(frames: dict[str, DataFrame], discriminator: str) -> DataFrame:
    """Several sources as one table with a discriminator column."""
    tagged = [df.withColumn(discriminator, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


__all__ = ["consolidate", "insert_ignoring", "mark_conflicts", "row_hash", "upsert"]
