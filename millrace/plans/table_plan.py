"""One spec as one DataFrame plan.

Order of work: source filter, newest row per key, schema-tolerant cleaning, reference joins, validation, rules,
unique keys, generated ids. A row is rejected for the first reason that applies: junk, orphan, validate, rule,
conflict. Joins happen on the source columns, before the target columns exist, so a shuffled row is not carried twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import canonical_text, trimmed
from millrace.functions.kinds import KINDS, READ_AS, kind_of
from millrace.functions.names import upper_name
from millrace.operators.joins import left_lookup, lookup_columns
from millrace.operators.merge import mark_conflicts
from millrace.operators.rank import assign_ids, first_per_key, number_rows
from millrace.sources.raw import row_json, row_struct
from millrace.spec import Reader, Reference, TableSpec, target_name

REASONS = ("junk", "orphan", "validate", "rule", "conflict")


@dataclass
class Planned:
    """Target columns plus _reason (null = good), _raw (JSON of rejected rows) and _disposition."""

    frame: DataFrame
    source: DataFrame
    missing: list[str]

    @property
    def good(self) -> DataFrame:
        return self.frame.where("_reason IS NULL").drop("_reason", "_raw", "_disposition")

    @property
    def rejected(self) -> DataFrame:
        return self.frame.where("_reason IS NOT NULL").select(F.col("_reason").alias("reason"), F.col("_raw").alias("row_data"))


def _ref(name: str) -> Column:
    return F.col(f"`{name}`")


def _with_missing(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    have = {c.lower() for c in df.columns}
    missing = [c for c in spec.source_columns() if c.lower() not in have]
    return df.withColumns({c: F.lit(None).cast("string") for c in missing}), missing


def target_names(spec: TableSpec, column: str) -> list[str]:
    """The target columns a source column goes to; none where it is left out."""
    key = column.lower()
    if key in {d.lower() for d in spec.drop} or column.startswith("_"):
        return []
    lower = lambda names: {n.lower(): v for n, v in names.items()}
    own = lower(spec.rename).get(key, target_name(column, spec.split_words))
    return [own, *lower(spec.mirror).get(key, ())]


def declared_kind(f: T.StructField) -> str:
    return f.metadata.get("kind") or kind_of(f.dataType)


def source_kind(spec: TableSpec, declared: T.StructType | None, column: str) -> str | None:
    """What a source column is to be read as before farms are united: num, bool, date or text; None if nothing says.

    Where its targets want different things it stays text, which loses nothing.
    """
    wanted = {f.name: declared_kind(f) for f in declared.fields} if declared else {}
    kinds = {spec.kind.get(name, wanted.get(name)) for name in target_names(spec, column)}
    if kinds <= {None}:
        return None
    read_as = {k and READ_AS.get(k, "text") for k in kinds}
    return read_as.pop() if len(read_as) == 1 else "text"


def target_columns(spec: TableSpec, schema: T.StructType, declared: T.StructType | None = None) -> dict[str, Column]:
    """Target column -> cleaned expression over the source columns.

    The kind is the spec's, else the declared target's, else that of the column's own type: names say nothing.
    """
    wanted = {f.name: f for f in declared.fields} if declared else {}
    out: dict[str, Column] = {}
    for f in schema.fields:
        for name in target_names(spec, f.name):
            kind = spec.kind.get(name) or (declared_kind(wanted[name]) if name in wanted else kind_of(f.dataType))
            cleaned = KINDS[kind](_ref(f.name), f.dataType)
            out[name] = cleaned.try_cast(wanted[name].dataType) if name in wanted else cleaned
    return out


def reference_mapping(ref: Reference, reader: Reader, scope: Sequence[str], whole: bool = False) -> DataFrame | None:
    """(scope..., _key, _value), one row per key; keys as whole numbers if `whole`, else as comparable text."""
    if ref.build:
        return ref.build(reader, list(scope))
    parent = reader(ref.target)
    if parent is None or ref.key not in parent.columns:
        return None
    key = comparable(_ref(ref.key), parent.schema[ref.key].dataType, ref.names, whole)
    value = _ref(ref.value) if ref.value else F.lit(True)
    rows = parent.select(*scope, key.alias("_key"), value.alias("_value")).where("_key IS NOT NULL")
    return rows.groupBy(*scope, "_key").agg(F.max("_value").alias("_value"))


def both_whole(ref: Reference, parent: DataFrame | None, dtype: T.DataType) -> bool:
    """Whether both ends of a reference are whole numbers and can be compared without going through text."""
    if ref.build or ref.names or parent is None or ref.key not in parent.columns:
        return False
    return isinstance(dtype, T.IntegralType) and isinstance(parent.schema[ref.key].dataType, T.IntegralType)


def comparable(c: Column, dtype: T.DataType, names: bool = False, whole: bool = False) -> Column:
    if whole:
        return c.cast("long")
    if names:
        return upper_name(canonical_text(c, dtype))
    return F.nullif(trimmed(canonical_text(c, dtype)), F.lit(""))


def _resolve(
    df: DataFrame, columns: dict[str, Column], references: Sequence[Reference], reader: Reader, scope: list[str]
) -> tuple[DataFrame, dict[str, Column], Column]:
    """Join every parent that is referred to, once; returns the frame, the new target columns and the orphan test."""
    orphan = F.lit(False)
    out = dict(columns)
    own = [r for r in references if r.column in columns]
    types = df.select(*[columns[r.column].alias(f"c{i}") for i, r in enumerate(own)]).schema.fields if own else []
    lookups: dict[tuple, tuple[DataFrame | None, dict[str, Column]]] = {}
    found: dict[int, str] = {}
    for i, (ref, f) in enumerate(zip(own, types, strict=True)):
        whole = both_whole(ref, None if ref.build else reader(ref.target), f.dataType)
        same = (ref.target, ref.key, ref.value, ref.names, ref.build, whole)
        if same not in lookups:
            lookups[same] = (reference_mapping(ref, reader, scope, whole), {})
        mapping, keys = lookups[same]
        if mapping is not None:
            found[i] = f"_found{i}"
            keys[found[i]] = comparable(columns[ref.column], f.dataType, ref.names, whole)
    df = lookup_columns(df, [x for x in lookups.values() if x[0] is not None], scope)
    for i, ref in enumerate(own):
        legacy, into = columns[ref.column], ref.into or ref.column
        if i not in found:
            if ref.required:
                # nothing to find a parent in: a row that names one is an orphan, and keeps no legacy id as if it were new
                orphan = orphan | legacy.isNotNull()
                out[into] = F.lit(None).cast("long")
            continue
        hit = F.col(found[i])
        if ref.value or ref.build:
            out[into] = hit
        else:
            out[into] = F.when(hit, legacy)
        if ref.also:
            out[ref.also] = F.coalesce(hit, out[ref.also]) if ref.also in out else hit
        if ref.required:
            orphan = orphan | (legacy.isNotNull() & hit.isNull())
    return df, out, orphan


def plan(
    spec: TableSpec,
    source: DataFrame,
    reader: Reader = lambda target: None,
    shared: Sequence[Reference] = (),
    declared: T.StructType | None = None,
    held: DataFrame | None = None,
    before: DataFrame | None = None,
) -> Planned:
    """Plan one spec.

    `reader` gives targets loaded earlier, `held` the rows the target already has in this load (its unique keys
    win), `before` the target's rows of an earlier run (its generated ids are kept).
    """
    df, missing = _with_missing(source, spec)
    if spec.prepare:
        df = spec.prepare(df)
    if spec.where:
        df = df.where(spec.where(df))
    scope = ["farm"] if "farm" in df.columns else []
    read = df
    if spec.latest:
        newest = [_ref(c).desc_nulls_last() for c in spec.latest.newest_by]
        df = first_per_key(df, [*scope, *spec.latest.key], newest)

    raw_columns = [c for c in source.columns if not c.startswith("_")]
    raw = row_struct(df, raw_columns)
    columns = target_columns(spec, df.schema, declared)
    columns |= {name: hook(df) for name, hook in spec.derive.items()}
    columns |= {name: F.lit(value) for name, value in spec.static.items()}
    if scope:
        columns["farm"] = F.col("farm")
    junk = F.coalesce(spec.skip(df), F.lit(False)) if spec.skip else F.lit(False)

    own = [r for r in shared if r.target not in spec.without and r.target != spec.target]
    df, columns, orphan = _resolve(df, columns, [*spec.references, *own], reader, scope)
    sort_columns = {f"_sort{i}": _ref(c) for i, c in enumerate(spec.sort)}
    shaped = df.select(
        *[c.alias(name) for name, c in columns.items()],
        F.when(junk, "junk").when(orphan, "orphan").alias("_early"),
        raw.alias("_raw"),
        *[c.alias(name) for name, c in sort_columns.items()],
    )
    names = list(columns)
    reason = F.col("_early")
    if spec.validate:
        reason = F.coalesce(reason, F.when(~F.coalesce(F.expr(spec.validate), F.lit(False)), "validate"))
    shaped = shaped.withColumn("_reason", reason).drop("_early")
    # a row that breaks a rule never reaches the target, so it takes no unique key either
    tests = {r.name: F.expr(r.test) for r in spec.rules if r.column is None or r.column in names}
    needed = [*spec.required, *(f.name for f in (declared.fields if declared else ()) if not f.nullable)]
    tests |= {f"required {c}": _ref(c).isNotNull() for c in needed if c in names}
    for name, test in tests.items():
        failed = ~F.coalesce(test, F.lit(True))
        shaped = shaped.withColumn("_reason", F.coalesce("_reason", F.when(failed, f"rule:{name}")))
    if spec.unique:
        order = [F.col(name).asc_nulls_first() for name in sort_columns]
        uniques = [(tuple([*scope, *u.parts]), u.where) for u in spec.unique if all(_known(p, names) for p in u.parts)]
        if uniques:
            shaped = mark_conflicts(shaped, held, uniques, order, keep=F.col("_reason").isNull())
            shaped = shaped.withColumn("_reason", F.coalesce("_reason", F.when(F.col("_conflict"), "conflict")))
    if spec.surrogate and spec.surrogate.column not in names:
        shaped = _with_ids(shaped, spec, scope, before)
        names.append(spec.surrogate.column)
    rejected = F.col("_reason").isNotNull()
    frame = shaped.select(
        *[_ref(n) for n in names],
        "_reason",
        # only rejected rows are turned into JSON
        F.when(rejected, row_json(F.col("_raw"))).alias("_raw"),
        F.when(rejected, "rejected").otherwise("good").alias("_disposition"),
    )
    return Planned(frame, read, missing)


def _known(part: str, names: Sequence[str]) -> bool:
    return part in names or "(" in part


def _with_ids(shaped: DataFrame, spec: TableSpec, scope: list[str], before: DataFrame | None) -> DataFrame:
    natural = [*scope, *spec.surrogate.natural]
    usable = before is not None and all(c in before.columns for c in [*natural, spec.surrogate.column])
    column = spec.surrogate.column
    good, rejected = shaped.where("_reason IS NULL"), shaped.where("_reason IS NOT NULL")
    ids = assign_ids(good, before if usable else None, natural, column)
    whole = F.lit(True)
    for part in natural:
        whole = whole & _ref(part).isNotNull()
    # a natural key names one good row, so the join has no frequent keys
    named = left_lookup(good.where(whole), ids, natural, salted=False)
    nameless = good.where(~whole)
    if not nameless.isEmpty():
        # rows without a natural key get ids after all others
        highest = ids.agg(F.max(column)).first()[0] or 0
        named = named.unionByName(number_rows(nameless, spec.surrogate.natural, column, highest))
    return named.unionByName(rejected.withColumn(column, F.lit(None).cast("long")))


def reason_class(reason: Column) -> Column:
    return F.substring_index(reason, ":", 1)


def outcome(frame: DataFrame) -> DataFrame:
    """Row counts of a planned or written frame, one column per disposition, from one aggregate."""
    cls = reason_class(F.col("_reason"))
    return frame.agg(
        F.count_if(F.col("_reason").isNull()).alias("rows_written"),
        *[F.count_if(cls == r).alias(f"rows_{r}") for r in REASONS],
    )


def rejected_counts(frame: DataFrame) -> DataFrame:
    return frame.where("_reason IS NOT NULL").groupBy(F.col("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("row_count"))


def rejected_samples(
    quarantine: DataFrame, keys: Sequence[str] = ("target_table", "reason"), size: int = 25, order: Sequence[Column] = ()
) -> DataFrame:
    """At most `size` example rows per table and reason, for people to read; counts stay exact elsewhere."""
    return first_per_key(quarantine, list(keys), [*order] or [F.col("row_data").asc()], k=size)
