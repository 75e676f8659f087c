"""Left joins of large tables to lookups that stay balanced when keys are not.

A lookup small enough for the session's broadcast limit is joined plainly, and Spark broadcasts it after its own
size check. A larger one is joined on (key, salt): a key with more than half a partition's share of the rows gets as many
salts as it has such halves, and missing keys are spread over all partitions, while the lookup rows of just those keys are
repeated. How many rows frequent keys have comes from a heavy-hitter sketch, one aggregate over all keys that are asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import durable

#: Share of the rows that the sketch is made of, and the keys it keeps count of.
SAMPLE = 0.1
TRACKED = 10_000
#: Groups of input tasks that rows of one key are told apart by before they are put together.
TASK_GROUPS = 64


def estimated_bytes(df: DataFrame) -> int | None:
    """Spark's own size estimate of a frame, or None where the session does not expose plans."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    stats = plan.queryExecution().optimizedPlan().stats()
    try:
        return int(str(stats.sizeInBytes()))
    except ValueError:
        # estimates of joins multiply, and after rounds of joins have more digits than are read
        return 1 << 63


def fits_broadcast(df: DataFrame) -> bool:
    limit = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    size = estimated_bytes(df)
    return size is not None and size <= limit


def _bytes(setting: str) -> int:
    text = setting.lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    return int(text[:-1]) * units[text[-1]] if text and text[-1] in units else int(text)


def task_salt(salts: int = TASK_GROUPS) -> Column:
    """A salt that is fixed per input task, so a retried task writes the same rows to the same places."""
    return F.pmod(F.spark_partition_id(), F.lit(salts))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _packed(keys: Sequence[str]) -> Column:
    return F.col(keys[0]) if len(keys) == 1 else F.to_json(F.struct(*keys))


def sketched(df: DataFrame, keys: Mapping[str, Sequence[str]], sample: float = SAMPLE, top: int | None = None) -> DataFrame:
    """One row: `rows`, and for each named key its most frequent values with their counts, in one pass over the keys."""
    drawn = df.select(*{c: None for names in keys.values() for c in names})
    if sample < 1:
        drawn = drawn.sample(fraction=sample, seed=17)
    top = min(top or 2 * partitions(df), TRACKED // 2)
    known = lambda names: F.coalesce(*[F.when(F.col(c).isNull(), False) for c in names], F.lit(True))
    packed = drawn.select("*", *[F.when(known(names), _packed(names)).alias(f"_packed_{n}") for n, names in keys.items()])
    tops = [F.expr(f"approx_top_k(`_packed_{n}`, {top}, {TRACKED})").alias(n) for n in keys]
    return packed.agg(F.count(F.lit(1)).alias("rows"), *tops)


def heavy_keys(df: DataFrame, sketch: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """(keys..., _salts) of the keys with more than half a partition's share: at most two for each partition."""
    pieces = F.ceil(2 * partitions(df) * F.col("n") / F.col("rows")).cast("int")
    found = sketch.select("rows", F.inline(name).alias("_item", "n")).where(F.col("_item").isNotNull()).select("_item", pieces.alias("_salts"))
    found = found.where("_salts > 1")
    if len(keys) == 1:
        return found.select(F.col("_item").alias(keys[0]), "_salts")
    parts = F.from_json("_item", T.StructType([df.schema[k] for k in keys]))
    return found.select(parts.alias("_item"), "_salts").select(*[F.col(f"_item.`{k}`").alias(k) for k in keys], "_salts")


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int, sample: float = SAMPLE) -> DataFrame:
    """The at most `limit` most frequent keys of a sample. Only balance depends on it, never a result."""
    found = sketched(df, {"top": keys}, sample, max(limit, 100)).select("rows", F.inline("top").alias("_item", "n"))
    found = found.where("_item IS NOT NULL AND n > 1").orderBy(F.col("n").desc(), "_item").limit(limit)
    if len(keys) == 1:
        return found.select(F.col("_item").alias(keys[0]))
    parts = F.from_json("_item", T.StructType([df.schema[k] for k in keys]))
    return found.select(parts.alias("_item")).select(*[F.col(f"_item.`{k}`").alias(k) for k in keys])


def left_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    sample: float = SAMPLE,
    salted: bool | None = None,
    keys_from: DataFrame | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Join `facts` to `lookup` (one row per key) on equally named columns. Rows of facts are kept as they are.

    `keys_from` is a cheaper frame with the same keys to look for frequent ones in: in a chain of lookups, the
    table the chain starts from. `heavy` is what `heavy_keys` found, where that is known already.
    """
    if salted is None:
        salted = not fits_broadcast(lookup)
    if not salted:
        return facts.join(lookup, list(on), how)
    if heavy is None:
        source = facts if keys_from is None else keys_from
        heavy = heavy_keys(source, sketched(source, {"top": on}, sample), "top", on)
    known = F.lit(True)
    for key in on:
        known = known & F.col(key).isNotNull()
    # `heavy` has two rows a partition at most, which bounds both broadcasts. A row's salt follows from what it holds and
    # the task it comes from, so a retried task writes the same rows to the same places.
    salts = F.when(~known, partitions(facts)).otherwise(F.coalesce("_salts", F.lit(1)))
    place = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in _hashable(facts)]), salts)
    spread = facts.join(F.broadcast(heavy), list(on), "left").withColumn("_salt", place.cast("int"))
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = lookup.join(F.broadcast(heavy), list(on), "left").withColumn("_salt", F.explode(every))
    joined = spread.drop("_salts").join(repeated.drop("_salts"), [*on, "_salt"], how)
    return joined.drop("_salt")


def _hashable(df: DataFrame) -> list[str]:
    """Columns of plain types: enough to tell rows apart, and cheap to hash."""
    plain = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, plain)]


def lookup_columns(
    facts: DataFrame,
    lookups: Sequence[tuple[DataFrame, Mapping[str, Column]]],
    scope: Sequence[str] = (),
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Look several columns up, in several lookups (scope..., _key, _value): each adds columns with the values found, named
    as in its mapping of names to key expressions.

    One lookup is joined once, however many columns are looked up in it. Equal expressions are one. Where the lookup is
    broadcast, further columns cost no shuffle and are joined in place; where it is not, the combinations of keys that rows
    have are taken once each, unpivoted, joined, folded back, and met by the rows on their combination. Frequent keys of all
    lookups that are not broadcast come from one sketch.
    """
    base = facts if keys_from is None else keys_from
    joins: list[tuple[str, DataFrame, dict[str, Column], Column, bool]] = []
    same: dict[str, str] = {}
    for i, (lookup, keys) in enumerate(lookups):
        own: dict[str, str] = {}
        same |= {name: own.setdefault(repr(c), name) for name, c in keys.items()}
        distinct = {name: keys[name] for name in own.values()}
        small = fits_broadcast(lookup)
        if len(distinct) == 1 or small:
            joins += [(f"_key{i}_{k}", lookup.withColumnRenamed("_value", n), {n: c}, c, small) for k, (n, c) in enumerate(distinct.items())]
        else:
            cells = F.array(*distinct.values())
            joins.append((f"_key{i}", lookup, distinct, F.when(F.coalesce(*distinct.values()).isNotNull(), F.to_json(cells)), False))
    large = {name: key for name, _, _, key, small in joins if not small}
    heavy: dict[str, DataFrame] = {}
    if large:
        keyed = base.select(*scope, *[key.alias(name) for name, key in large.items()])
        # a row of fixed size, written so that the sketch is made once
        sketch = durable(sketched(keyed, {name: [*scope, name] for name in large}))
        heavy = {name: heavy_keys(keyed, sketch, name, [*scope, name]) for name in large}
    for name, lookup, keys, key, small in joins:
        if len(keys) > 1:
            lookup = _folded(base, lookup, keys, key, scope)
        lookup = lookup.withColumnRenamed("_key", name)
        facts = left_lookup(facts.withColumn(name, key), lookup, [*scope, name], salted=not small, heavy=heavy.get(name)).drop(name)
    return facts.withColumns({name: F.col(held) for name, held in same.items() if name != held})


def _folded(base: DataFrame, lookup: DataFrame, keys: Mapping[str, Column], combination: Column, scope: Sequence[str]) -> DataFrame:
    """(scope..., _key, a column for each of `keys`): what each combination of keys finds, by one join."""
    narrow = base.select(*scope, combination.alias("_all"), F.array(*keys.values()).alias("_cells"))
    once = narrow.where("_all IS NOT NULL").dropDuplicates([*scope, "_all"])
    cells = once.select(*scope, "_all", F.posexplode("_cells").alias("_slot", "_key")).where("_key IS NOT NULL")
    met = left_lookup(cells, lookup, [*scope, "_key"], "inner", salted=True)
    found = [F.max(F.when(F.col("_slot") == i, F.col("_value"))).alias(name) for i, name in enumerate(keys)]
    return met.groupBy(*scope, F.col("_all").alias("_key")).agg(*found)
