"""Reading legacy tables of one or many farms."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import canonical_text
from millrace.functions.kinds import KINDS, kind_of, unread

# Companion databases are told apart by the end of their name.
GROUP_SUFFIXES = {"_feedtrans": "feedtrans", "_feed": "feed"}

# How databases say that they have no such table: the standard's states, and vendors' own numbers.
MISSING_STATES = ("42P01", "42S02", "42X05")
MISSING_CODES = {"SQLServerException": 208, "OracleDatabaseException": 942, "MySQLSyntaxErrorException": 1146}


def missing_table(error: BaseException) -> bool:
    """Whether a load failed because the database has no such table, by the state or number of its own error.

    The words of a message decide nothing: an unknown host, database or column is not a missing table.
    """
    cause = getattr(error, "_origin", None) or getattr(error, "java_exception", None)
    for _ in range(20):
        if cause is None:
            return False
        kind = cause.getClass()
        if any(m.getName() == "getSQLState" for m in kind.getMethods()):
            code = next((n for name, n in MISSING_CODES.items() if kind.getSimpleName() == name), None)
            return cause.getSQLState() in MISSING_STATES or (code is not None and cause.getErrorCode() == code)
        cause = cause.getCause()
    return False


def database_group(database_name: str) -> str:
    """Which of a farm's databases a name stands for: main, feed or feedtrans."""
    lowered = database_name.lower()
    for suffix, group in GROUP_SUFFIXES.items():
        if lowered.endswith(suffix):
            return group
    return "main"


def _match(columns: Iterable[str], wanted: str) -> str | None:
    return next((c for c in columns if c.lower() == wanted.lower()), None)


@dataclass(frozen=True)
class ParquetSource:
    """One parquet folder per table under root/<farm>/<group>/ (any part may be left out)."""

    spark: SparkSession
    root: str
    groups: Mapping[str, str] = field(default_factory=lambda: {"main": "", "feed": "feed", "feedtrans": "feedtrans"})

    def read(self, table: str, group: str = "main", farm: str | None = None) -> DataFrame | None:
        """The table, or None where the farm has no such table or no such database."""
        if group not in self.groups:
            return None
        parts = [self.root, farm or "", self.groups[group], f"{table}.parquet"]
        path = "/".join(part.rstrip("/") for part in parts if part)
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise


@dataclass(frozen=True)
class JdbcSource:
    """Tables of live databases, read in ranges of a numeric column so that many tasks share one table.

    `urls` has a database for each (farm, group); for a single farm the group alone is enough.
    """

    spark: SparkSession
    urls: Mapping[str | tuple[str, str], str]
    options: Mapping[str, str] = field(default_factory=dict)
    split_on: Mapping[str, tuple[str, int, int, int]] = field(default_factory=dict)

    def reader_options(self, table: str, group: str = "main", farm: str | None = None) -> dict[str, str] | None:
        url = self.urls.get(group if farm is None else (farm, group))
        if url is None:
            return None
        chosen = {"url": url, "dbtable": table, "fetchsize": "10000", **self.options}
        if table in self.split_on:
            column, low, high, parts = self.split_on[table]
            chosen |= {
                "partitionColumn": column,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(parts),
            }
        return chosen

    def read(self, table: str, group: str = "main", farm: str | None = None) -> DataFrame | None:
        """The table, or None where the farm has no such table or no such database."""
        options = self.reader_options(table, group, farm)
        if options is None:
            return None
        try:
            return self.spark.read.format("jdbc").options(**options).load()
        except PySparkException as error:
            if missing_table(error):
                return None
            raise


def project_tolerant(df: DataFrame, wanted: Mapping[str, T.DataType]) -> tuple[DataFrame, list[str]]:
    """Project to the wanted columns whatever their letter case; absent ones become typed nulls and are reported."""
    columns, missing = [], []
    for name, dtype in wanted.items():
        found = _match(df.columns, name)
        if found is None:
            missing.append(name)
            columns.append(F.lit(None).cast(dtype).alias(name))
        else:
            columns.append(F.col(f"`{found}`").alias(name))
    return df.select(*columns), missing


def unite_farms(frames: Mapping[str, DataFrame], kind_for: Callable[[str], str | None] | None = None) -> DataFrame:
    """All farms' copies of one table as one frame with a `farm` column; absent columns are null. No cell stops the load.

    Where farms store a column as different things, `kind_for` (num, bool, date or text by column name) decides what it is
    read as. Where it says nothing, text is read as the numbers, dates or flags of the other farms only if that loses no
    cell of any farm, which one pass over just those columns finds out; otherwise the column is text on all farms.
    """
    types: dict[str, set] = {}
    for df in frames.values():
        for f in df.schema.fields:
            types.setdefault(f.name.lower(), set()).add(f.dataType)
    kinds = {name: {kind_of(t) for t in found} for name, found in types.items()}
    mixed = {name for name, found in kinds.items() if len(found) > 1}
    read_as = {name: kind_for(name) if kind_for else None for name in mixed}
    guesses = {n: next(iter(kinds[n] - {"text"})) for n in mixed if read_as[n] is None and "text" in kinds[n] and len(kinds[n]) == 2}
    lossless = _lossless(frames, {n: k for n, k in guesses.items() if k in ("num", "bool", "date")})
    read_as = {n: guesses[n] if n in lossless else (read_as[n] or "text") for n in mixed}

    def aligned(df: DataFrame) -> DataFrame:
        changed = {}
        for f in df.schema.fields:
            name, own = f.name.lower(), F.col(f"`{f.name}`")
            if name in mixed:
                kind = read_as[name]
                changed[f.name] = canonical_text(own, f.dataType) if kind == "text" else KINDS[kind](own, f.dataType)
            elif kinds[name] == {"date"} and len(types[name]) > 1:
                changed[f.name] = own.cast("timestamp")
        return df.withColumns(changed) if changed else df

    tagged = [aligned(df).withColumn("farm", F.lit(farm)) for farm, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _lossless(frames: Mapping[str, DataFrame], kinds: Mapping[str, str]) -> set[str]:
    """Columns whose text cells can all be read as the given kinds: one job over those columns of all farms."""
    counted = []
    for df in frames.values():
        texts = {f.name.lower(): f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        tests = [(F.count_if(unread(F.col(f"`{texts[n]}`"), k)) if n in texts else F.lit(0)).alias(n) for n, k in kinds.items()]
        if any(n in texts for n in kinds):
            counted.append(df.agg(*tests))
    if not counted:
        return set()
    total = reduce(DataFrame.union, counted).agg(*(F.sum(f"`{n}`").alias(n) for n in kinds)).first()
    return {n for n in kinds if not total[n]}


def schema_presence(spark: SparkSession, schemas: Mapping[str, Mapping[str, T.StructType]]) -> DataFrame:
    """Over farms -> tables -> schema: how many farms have each column, and with which types.

    The input is schemas, not data, so its size is the number of declared columns.
    """
    rows = [
        (farm, table, f.name, f.dataType.simpleString())
        for farm, tables in schemas.items()
        for table, schema in tables.items()
        for f in schema.fields
    ]
    fields = spark.createDataFrame(rows, "farm string, table_name string, column_name string, type_name string")
    return fields.groupBy("table_name", "column_name").agg(
        F.countDistinct("farm").alias("present_in"),
        F.lit(len(schemas)).cast("long").alias("farms"),
        F.array_join(F.array_sort(F.collect_set("type_name")), ",").alias("types_seen"),
    )
