"""Writing targets, rejected rows and the run log.

A target is kept as root/<target>/source=<source>/run=<run id>, split by disposition. A run writes each of its
folders once and appends a log row last, so readers see a source's newest *completed* run and never a half
written one; a target whose source is absent keeps what it had.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("farm", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("rows_deduped", T.LongType()),
        T.StructField("rows_junk", T.LongType()),
        T.StructField("rows_orphan", T.LongType()),
        T.StructField("rows_validate", T.LongType()),
        T.StructField("rows_conflict", T.LongType()),
        T.StructField("rows_rule", T.LongType()),
        T.StructField("missing_columns", T.StringType()),
        T.StructField("error_details", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
    ]
)

GOOD, REJECTED = "good", "rejected"
YEAR_PART, DEFAULT_PART = "_year", "__default__"


def _read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if any(reason in str(error) for reason in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            return None
        raise


class TargetStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, target: str, source: str, run_id: int) -> str:
        return f"{self.root}/tables/{target}/source={source}/run={run_id}"

    def write(
        self, planned: DataFrame, target: str, source: str, run_id: int, years: tuple[str, int, int] | None = None
    ) -> DataFrame:
        """Write a planned frame once; good and rejected rows go to separate folders of the same job, and with `years` (date
        column, first, last year) the years of a target to separate folders below them."""
        folder = self._folder(target, source, run_id)
        parts = ["_disposition"]
        if years and years[0] in planned.columns:
            planned = by_year(planned, *years, name=YEAR_PART, prefix="y")
            parts.append(YEAR_PART)
        planned.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts).parquet(folder)
        written = _read(self.spark, folder)
        return planned.limit(0) if written is None else written

    def write_extra(self, df: DataFrame, target: str, source: str, run_id: int) -> None:
        """Rows a derivation adds to a target, under a source name of their own."""
        df.write.mode("overwrite").parquet(f"{self._folder(target, source, run_id)}/_disposition={GOOD}")

    def current_runs(self) -> dict[tuple[str, str], int]:
        """Newest completed run per (source, target): one row per declared table, not per data row."""
        log = self.log()
        if log is None:
            return {}
        latest = (
            log.where(F.col("status") == "completed")
            .groupBy("source_table", "target_table")
            .agg(F.max("run_id").alias("run_id"))
        )
        return {(r["source_table"], r["target_table"]): r["run_id"] for r in latest.collect()}

    def read(
        self, target: str, runs: dict[tuple[str, str], int] | None = None, years: tuple[int, int] | None = None
    ) -> DataFrame | None:
        """The current rows of a target over all its sources.

        `years` leaves out the parts of other years where the target is kept by year: rows of the default part stay, as their
        dates are missing or lie outside all years, so a condition on the date itself still belongs to the reader.
        """
        runs = self.current_runs() if runs is None else runs
        frames = []
        for (source, name), run_id in sorted(runs.items()):
            if name == target:
                df = _read(self.spark, f"{self._folder(target, source, run_id)}/_disposition={GOOD}")
                if df is not None:
                    if YEAR_PART in df.columns:
                        wanted = [f"y{y}" for y in range(years[0], years[1] + 1)] if years else []
                        df = (df.where(F.col(YEAR_PART).isin(*wanted, DEFAULT_PART)) if years else df).drop(YEAR_PART)
                    frames.append(df.withColumn("_source_table", F.lit(source)))
        if not frames:
            return None
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def quarantine(self, runs: dict[tuple[str, str], int] | None = None) -> DataFrame | None:
        """Rejected rows of all current runs: (source_table, target_table, reason, row_data)."""
        runs = self.current_runs() if runs is None else runs
        frames = []
        for (source, target), run_id in sorted(runs.items()):
            df = _read(self.spark, f"{self._folder(target, source, run_id)}/_disposition={REJECTED}")
            if df is not None:
                frames.append(
                    df.select(
                        F.lit(source).alias("source_table"),
                        F.lit(target).alias("target_table"),
                        F.col("_reason").alias("reason"),
                        F.col("_raw").alias("row_data"),
                    )
                )
        return reduce(DataFrame.unionByName, frames) if frames else None

    def write_raw(self, df: DataFrame, source: str, run_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/raw/source={source}/run={run_id}")

    def raw(self, source: str, run_id: int) -> DataFrame | None:
        return _read(self.spark, f"{self.root}/raw/source={source}/run={run_id}")

    def append_log(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root}/log")

    def log(self) -> DataFrame | None:
        return _read(self.spark, f"{self.root}/log", LOG_SCHEMA)


def by_year(
    df: DataFrame, date_column: str, first_year: int, last_year: int, name: str = "year", prefix: str = ""
) -> DataFrame:
    """Add the partition column of a yearly layout; dates outside the range or missing go to __default__."""
    year = F.year(date_column)
    inside = year.between(first_year, last_year)
    return df.withColumn(name, F.when(inside, F.concat(F.lit(prefix), year.cast("string"))).otherwise(DEFAULT_PART))
