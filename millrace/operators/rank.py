"""Keeping, flagging and numbering rows per key or over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import left_lookup, task_salt
from millrace.session import durable


def row_hash(df: DataFrame) -> Column:
    """Last resort of an order: rows that still tie are copies of each other."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first `k` rows of each key.

    Spark cuts each task's rows to `k` per key before the shuffle (window group limit), so a key with a third
    of all rows still sends only `k` rows per task.
    """
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order, row_hash(df))))
    return ranked.where(F.col("_n") <= k).drop("_n")


def flag_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], flag: str = "_first", total: bool = False
) -> DataFrame:
    """Keep every row and mark the first of each key. Rows with a null in the key are all marked.

    Two rounds: the first row per (key, input task group), then the first among those winners. Losers of the
    first round keep their salt, so no task ever holds all rows of a frequent key.
    """
    order = [*order] if total else [*order, row_hash(df)]
    columns = df.columns
    salted = df.withColumn("_salt", task_salt())
    local = salted.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)) == 1
    ).withColumn("_group", F.when(F.col("_local"), F.lit(-1)).otherwise(F.col("_salt")))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    final = local.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_group").orderBy(*order)))
    first = missing | (F.col("_local") & (F.col("_n") == 1))
    return final.select(*[F.col(f"`{c}`") for c in columns], first.alias(flag))


def number_rows(
    df: DataFrame, order: Sequence[str | Column], name: str, start: int = 0, within: Sequence[str] = ()
) -> DataFrame:
    """Number all rows start+1, start+2, ... in the given order without sorting them in one task.

    With `within` the numbers restart for each value of those columns, however many rows share it.
    Rows are range partitioned (an input row id splits runs of equal rows) and written down once; the
    partition sizes, one number per partition, then give each partition its offset.
    """
    total = [*[F.col(c) if isinstance(c, str) else c for c in [*within, *order]], row_hash(df), F.col("_tie")]
    sorted_parts = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*total)
        .sortWithinPartitions(*total)
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    fixed = durable(sorted_parts)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = fixed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = fixed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    numbered = numbered.withColumn(name, F.lit(start) + F.col("_offset") + place + 1).drop("_part", "_offset", "_at")
    if not within:
        return numbered
    firsts = numbered.groupBy(*within).agg(F.min(name).alias("_from"))
    restarted = left_lookup(numbered, firsts, list(within))
    return restarted.withColumn(name, F.col(name) - F.col("_from") + start + 1).drop("_from")


def assign_ids(candidates: DataFrame, existing: DataFrame | None, natural: Sequence[str], id_column: str) -> DataFrame:
    """Ids for natural keys: known keys keep theirs, new keys follow the largest id in key order."""
    keys = candidates.select(*natural).dropna().dropDuplicates()
    if existing is None:
        return number_rows(keys, natural, id_column)
    known = existing.select(*natural, id_column).dropna()
    # one aggregate value comes back to the driver
    highest = known.agg(F.max(id_column)).first()[0] or 0
    fresh = number_rows(keys.join(known, list(natural), "left_anti"), natural, id_column, highest)
    return known.select(*natural, F.col(id_column).cast("long").alias(id_column)).unionByName(fresh)


def disambiguate(
    df: DataFrame,
    name: str,
    row_id: str,
    out: str,
    repeated_as: str = "Unknown",
    single_as: str = "Unknown ",
    scope: Sequence[str] = (),
) -> DataFrame:
    """Make names unique: 'X' held twice (letter case aside) becomes 'X (ID:n)'.

    Names repeat within `scope`. Missing names count as equal; several become `repeated_as` (ID:n), a single one `single_as` + its id.
    """
    trimmed = F.trim(F.col(name))
    id_text = F.col(row_id).cast("string")
    keyed = df.withColumn("_missing", F.col(name).isNull()).withColumn("_name", F.coalesce(F.upper(trimmed), F.lit("")))
    keys = [*scope, "_missing", "_name"]
    repeated = keyed.groupBy(*keys).count().where(F.col("count") > 1).select(*keys, F.lit(True).alias("_repeated"))
    joined = left_lookup(keyed, repeated, keys)
    tagged = F.concat(F.coalesce(trimmed, F.lit(repeated_as)), F.lit(" (ID:"), id_text, F.lit(")"))
    single = F.coalesce(trimmed, F.concat(F.lit(single_as), id_text))
    named = F.when(F.col("_repeated"), tagged).otherwise(single)
    return joined.withColumn(out, named).drop("_missing", "_name", "_repeated")


def ranked_assignments(
    df: DataFrame, key: str, member: str, status: str, order: Sequence[Column], current: str = "active"
) -> DataFrame:
    """One current holder per key: the first row in status `current`; all others are switched off with a reason."""
    held = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    is_current = F.col(status) == current
    ranked = flag_first(held, [key], [is_current.desc_nulls_last(), *order, F.col(member).desc()], "_top")
    holder = is_current & F.col("_top")
    reason = F.when(~is_current, F.col(status)).when(~F.col("_top"), F.lit("dedup"))
    return ranked.withColumn("active", holder).withColumn("deactivated_reason", reason).drop("_top")
