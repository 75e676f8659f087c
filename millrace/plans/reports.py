"""Data quality and comparison reports. Every report is a DataFrame."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import canonical_text, trimmed
from millrace.functions.kinds import kind_of, unread
from millrace.operators.quality import date_ranges, duplicate_groups, duplicate_summary, null_rates
from millrace.operators.rank import first_per_key
from millrace.plans.checks import Check, ReferenceCheck, RowCheck, UniqueCheck, compiled
from millrace.plans.table_plan import declared_kind, target_columns, target_names
from millrace.spec import TableSpec

# The limits of the reports.
NULL_WARN_PCT = 30.0
ORPHAN_FAIL_PCT = 5.0

#: Parts that tables are compared in.
BUCKETS = 4096


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row frames as one row, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def profile(df: DataFrame, name: str, key: str | None = None, date_columns: Sequence[str] = ()) -> DataFrame:
    """One row: row count, columns with many nulls, duplicate keys, date ranges, PASS / WARN / FAIL."""
    rates = null_rates(df)
    high = F.when(F.col("null_pct") > NULL_WARN_PCT, F.col("column_name"))
    parts = [
        rates.agg(
            F.max("row_count").alias("row_count"),
            F.array_join(F.array_sort(F.collect_list(high)), ",").alias("high_null_columns"),
        )
    ]
    if key:
        parts.append(duplicate_summary(duplicate_groups(df, [key])))
    if date_columns:
        text = F.concat_ws(
            " ", "column_name", F.date_format("min_date", "yyyy-MM-dd"), F.date_format("max_date", "yyyy-MM-dd")
        )
        ranges = date_ranges(df, date_columns)
        parts.append(ranges.agg(F.array_join(F.array_sort(F.collect_list(text)), ",").alias("date_ranges")))
    nulls = _side_by_side(*parts)
    if not key:
        nulls = nulls.withColumns({"duplicate_groups": F.lit(0).cast("long"), "excess_rows": F.lit(0).cast("long")})
    if not date_columns:
        nulls = nulls.withColumn("date_ranges", F.lit(""))
    status = (
        F.when(F.col("duplicate_groups") > 0, "FAIL").when(F.col("high_null_columns") != "", "WARN").otherwise("PASS")
    )
    return nulls.select(
        F.lit(name).alias("table_name"),
        "row_count",
        "high_null_columns",
        "duplicate_groups",
        "excess_rows",
        "date_ranges",
        status.alias("status"),
    )


def profile_all(tables: Mapping[str, DataFrame], meta: Mapping[str, tuple[str | None, Sequence[str]]]) -> DataFrame:
    return _union([profile(df, name, *meta.get(name, (None, ()))) for name, df in tables.items()])


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    key: str

    @property
    def label(self) -> str:
        return f"{self.child}.{self.column} -> {self.parent}.{self.key}"


def reference_counts(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """One row (total, orphans) of set references and of those without a parent.

    References are counted by value before they meet the parent, so a frequent value is one row there and the child is
    read once.
    """
    held = child.groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where("_key IS NOT NULL")
    known = parent.select(F.col(key).alias("_key")).dropna().dropDuplicates().withColumn("_known", F.lit(True))
    met = held.join(known, "_key", "left")
    lost = F.when(F.col("_known").isNull(), F.col("_n")).otherwise(0)
    return met.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.coalesce(F.sum(lost), F.lit(0)).alias("orphans"))


def fk_audit(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey]) -> DataFrame:
    """Per foreign key: set references, orphans, their share, PASS / WARN / FAIL."""
    out = []
    for fk in keys:
        counted = reference_counts(tables[fk.child], fk.column, tables[fk.parent], fk.key)
        out.append(counted.select(F.lit(fk.label).alias("foreign_key"), "total", "orphans"))
    pct = F.when(F.col("total") > 0, F.col("orphans") * 100.0 / F.col("total")).otherwise(F.lit(0.0))
    status = F.when(pct > ORPHAN_FAIL_PCT, "FAIL").when(F.col("orphans") > 0, "WARN").otherwise("PASS")
    return _union(out).select("*", F.round(pct, 2).alias("orphan_pct"), status.alias("status"))


def coverage(
    tables: DataFrame, categories: DataFrame, patterns: Sequence[tuple[str, str]] = (), mapped: Sequence[str] = ()
) -> DataFrame:
    """Give every source table (table_name, row_count) its strategy: by exact name, else by pattern.

    A table without one is an error; a table that is `raw` although a mapping loads it is a conflict.
    `categories` is (table_name, strategy): one row per declared table.
    """
    by_pattern = F.lit(None).cast("string")
    for pattern, strategy in reversed(patterns):
        by_pattern = F.when(F.col("table_name").rlike(pattern), strategy).otherwise(by_pattern)
    joined = tables.join(categories.withColumnRenamed("strategy", "_named"), "table_name", "left")
    strategy = F.coalesce("_named", by_pattern, F.lit("uncategorised"))
    clash = (strategy == "raw") & F.col("table_name").isin(*mapped) if mapped else F.lit(False)
    issue = F.when(strategy == "uncategorised", "uncategorised").when(clash, "category_conflict")
    return joined.select("table_name", "row_count", strategy.alias("strategy"), issue.alias("issue"))


def coverage_totals(report: DataFrame) -> DataFrame:
    return report.groupBy("strategy").agg(
        F.count(F.lit(1)).alias("table_count"), F.sum("row_count").alias("row_count"), F.count("issue").alias("issues")
    )


def check_specs(spark: SparkSession, specs: Sequence[TableSpec], produced: Mapping, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """Target columns a spec writes that the declared target lacks. `produced` maps a spec to its columns."""
    rows = []
    for spec in specs:
        schema = schemas.get(spec.target)
        if schema is None:
            rows.append((spec.source, spec.target, None, "no_schema"))
            continue
        known = {f.name for f in schema.fields}
        rows += [(spec.source, spec.target, c, "unknown_column") for c in produced(spec) if c not in known]
    return spark.createDataFrame(rows, "source_table string, target_table string, column_name string, problem string")


def lost_cells(spec: TableSpec, source: DataFrame, declared: T.StructType | None = None) -> DataFrame:
    """(source_table, target_table, column_name, cells, lost): cells that say something, and those of them that their
    declared kind cannot take. One pass over the source.

    Kinds that set certain values to null on purpose (references to 0, negative numbers) are not looked at.
    """
    columns = target_columns(spec, source.schema, declared)
    wanted = {f.name: declared_kind(f) for f in declared.fields} if declared else {}
    counts = []
    for f in source.schema.fields:
        said = trimmed(canonical_text(F.col(f"`{f.name}`"), f.dataType)) != ""
        for name in target_names(spec, f.name):
            kind = spec.kind.get(name) or wanted.get(name) or kind_of(f.dataType)
            if kind not in ("num", "date", "bool", "text", "time", "real_date"):
                continue
            lost = unread(F.col(f"`{f.name}`"), "bool") if kind == "bool" else columns[name].isNull()
            if kind == "bool" and not isinstance(f.dataType, T.StringType):
                lost = F.lit(False)
            counts.append(F.struct(F.lit(name).alias("column_name"), F.count_if(said).alias("cells"), F.count_if(said & lost).alias("lost")))
    one = source.agg(F.array(*counts).alias("c"))
    return one.select(F.lit(spec.source).alias("source_table"), F.lit(spec.target).alias("target_table"), F.inline("c"))


def spec_problems(spark: SparkSession, sources: Sequence[tuple[TableSpec, DataFrame]], schemas: Mapping[str, T.StructType]) -> DataFrame:
    """(source_table, target_table, column_name, cells, lost, problem) over specs and their sources: what `check_specs` finds,
    with the cells each unknown column holds, and columns whose declared kind cannot take some of their cells."""
    keys = ["source_table", "target_table", "column_name"]
    produced = {(spec.source, spec.target): [n for c in df.columns for n in target_names(spec, c)] for spec, df in sources}
    declared = check_specs(spark, [s for s, _ in sources], lambda s: produced[(s.source, s.target)], schemas)
    cells = _union([lost_cells(spec, df, schemas.get(spec.target)) for spec, df in sources])
    lost = F.when(F.col("lost") > 0, "lost_cells")
    # both sides have a row for each declared column
    return cells.join(declared, keys, "full").select(*keys, "cells", "lost", F.coalesce("problem", lost).alias("problem")).where("problem IS NOT NULL")


def check(name: str, failing: DataFrame, what: str, count: Column | None = None) -> DataFrame:
    """One row (check, passed, detail): passes when `failing` has no rows."""
    counted = failing.agg(F.count(F.lit(1)).alias("n") if count is None else count.alias("n"))
    return counted.select(
        F.lit(name).alias("check"),
        (F.col("n") == 0).alias("passed"),
        F.concat(F.lit(f"{what}: "), F.col("n").cast("string")).alias("detail"),
    )


def count_checks(log: DataFrame) -> DataFrame:
    """Per (source, target) of the log: every row read was written or rejected for a known reason."""
    parts = ["rows_written", "rows_deduped", "rows_junk", "rows_orphan", "rows_validate", "rows_conflict", "rows_rule"]
    accounted = reduce(lambda a, b: a + b, [F.coalesce(F.col(p), F.lit(0)) for p in parts])
    return log.where(F.col("status") == "completed").select(
        F.concat_ws("", F.lit("row count: "), "source_table", F.lit(" -> "), "target_table").alias("check"),
        (accounted == F.col("rows_read")).alias("passed"),
        F.concat_ws("", F.lit("read "), F.col("rows_read"), F.lit(", accounted "), accounted).alias("detail"),
    )


def fk_checks(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey]) -> list[Check]:
    found = [k for k in keys if k.child in tables and k.parent in tables]
    return [ReferenceCheck(f"foreign key: {k.label}", tables[k.child], k.column, tables[k.parent], k.key) for k in found]


def filled_checks(tables: Mapping[str, DataFrame], pairs: Sequence[tuple[str, str, str]]) -> list[Check]:
    """(table, legacy column, new column): rows with the legacy reference but not the new one."""
    return [
        RowCheck(f"{new} filled: {t}", tables[t], F.col(old).isNotNull() & F.col(new).isNull(), "rows without it")
        for t, old, new in pairs
        if t in tables
    ]


def rule_check(name: str, df: DataFrame, failing: Column) -> DataFrame:
    return compiled([RowCheck(name, df, failing)])


def loaded_check(name: str, sources: Sequence[DataFrame], target: DataFrame) -> DataFrame:
    """When the sources hold rows, the target must too."""
    have = _union([s.agg(F.count(F.lit(1)).alias("n")) for s in sources]).agg(F.sum("n").alias("source_rows"))
    got = target.agg(F.count(F.lit(1)).alias("target_rows"))
    return _side_by_side(have, got).select(
        F.lit(name).alias("check"),
        ((F.col("source_rows") == 0) | (F.col("target_rows") > 0)).alias("passed"),
        F.concat_ws("", F.lit("source "), "source_rows", F.lit(", target "), "target_rows").alias("detail"),
    )


def all_checks(checks: Sequence[DataFrame | Check]) -> DataFrame:
    """(check, passed, detail): reports as they are, and declared checks compiled, at most two scans a table."""
    declared = [c for c in checks if not isinstance(c, DataFrame)]
    reported = [c.select("check", "passed", "detail") for c in checks if isinstance(c, DataFrame)]
    return _union([*reported, *([compiled(declared)] if declared else [])])


def reconcile(pairs: Mapping[str, tuple[DataFrame | None, DataFrame | None]]) -> DataFrame:
    """Rows per (source, target part): counts, difference, match. A source that is absent counts as matching 0."""
    out = []
    spark = next(df.sparkSession for pair in pairs.values() for df in pair if df is not None)
    for name, (source, target) in pairs.items():
        if source is None:
            out.append(spark.createDataFrame([(name, 0, 0)], "table_name string, source_rows long, target_rows long"))
            continue
        s = source.agg(F.count(F.lit(1)).alias("source_rows"))
        if target is None:
            out.append(s.select(F.lit(name).alias("table_name"), "source_rows", F.lit(0).cast("long").alias("target_rows")))
            continue
        t = target.agg(F.count(F.lit(1)).alias("target_rows"))
        out.append(_side_by_side(s, t).select(F.lit(name).alias("table_name"), "source_rows", "target_rows"))
    delta = F.col("source_rows") - F.col("target_rows")
    return _union(out).select("*", delta.alias("delta"), (delta == 0).alias("match"))


def comparison_text(df: DataFrame, column: str) -> Column:
    return F.coalesce(trimmed(canonical_text(F.col(f"`{column}`"), df.schema[column].dataType)), F.lit(""))


def diff(
    source: DataFrame, target: DataFrame, source_key: str, target_key: str, columns: Mapping[str, str], buckets: int = BUCKETS
) -> DataFrame:
    """(key, kind, field, source_value, target_value) over all keys: missing, extra and differing fields.

    Rows that share a key are compared by one row each: the one that is largest by its compared values. Keys are dealt into
    buckets by hash; a bucket whose two sides have equal checksums is the same on both, and only the others' rows meet.
    """

    def side(df: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
        values = F.array(*[comparison_text(df, n) for n in names]) if names else F.array().cast("array<string>")
        rows = df.where(F.col(f"`{key}`").isNotNull()).select(comparison_text(df, key).alias("key"), values.alias("v"))
        return rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))

    def digests(rows: DataFrame, sign: int) -> DataFrame:
        # two hashes of every row, added up modulo 2^64, and the number of rows
        one, two = F.xxhash64("key", "v"), F.xxhash64(F.lit(1), "v", "key")
        sums = [F.sum(F.shiftrightunsigned(h, s).bitwiseAND(0xFFFFFFFF) * sign) for h in (one, two) for s in (0, 32)]
        return rows.groupBy("bucket").agg(F.sum(F.lit(sign)).alias("n"), *[x.alias(f"s{i}") for i, x in enumerate(sums)])

    left, right = side(source, source_key, list(columns)), side(target, target_key, list(columns.values()))
    names = ["n", "s0", "s1", "s2", "s3"]
    both = digests(left, 1).union(digests(right, -1)).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names])
    # at most a number for each bucket
    differing = F.broadcast(both.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in names])).select("bucket"))
    largest = [F.col("v").desc()]
    left = first_per_key(left.join(differing, "bucket", "left_semi"), ["key"], largest).select("key", F.col("v").alias("s"))
    right = first_per_key(right.join(differing, "bucket", "left_semi"), ["key"], largest).select("key", F.col("v").alias("t"))
    fields = F.array(*[F.lit(n) for n in columns.values()]) if columns else F.array().cast("array<string>")
    cells = F.filter(
        F.transform(
            F.arrays_zip(fields.alias("f"), F.col("s"), F.col("t")),
            lambda c: F.struct(
                F.lit("field").alias("kind"), c["f"].alias("field"), c["s"].alias("source_value"), c["t"].alias("target_value")
            ),
        ),
        lambda c: c["source_value"] != c["target_value"],
    )
    text = F.lit(None).cast("string")

    def lone(kind: str) -> Column:
        return F.array(
            F.struct(F.lit(kind).alias("kind"), text.alias("field"), text.alias("source_value"), text.alias("target_value"))
        )

    found = F.when(F.col("t").isNull(), lone("missing")).when(F.col("s").isNull(), lone("extra")).otherwise(cells)
    return left.join(right, "key", "full").select("key", F.inline(found))


def stale_columns(df: DataFrame, stale: Sequence[str]) -> list[str]:
    """Columns that should be gone but are still there."""
    return [c for c in stale if c in df.columns]
