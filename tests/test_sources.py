import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import json_cell
from millrace.sources import (
    JdbcSource,
    ParquetSource,
    TargetStore,
    by_year,
    capture_raw,
    capture_raw_tables,
    database_group,
    project_tolerant,
    register_views,
    schema_presence,
    unite_farms,
)
from millrace.streaming import running_counts


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_database_group():
    assert [database_group(n) for n in ("CATTLE", "CATTLE_feed", "cattle_FEEDTRANS")] == ["main", "feed", "feedtrans"]


def test_parquet_source(spark, tmp_path, sf_dir):
    assert ParquetSource(spark, sf_dir).read("nation").count() == 25
    assert ParquetSource(spark, sf_dir).read("no_such_table") is None
    assert ParquetSource(spark, sf_dir).read("nation", "no_such_group") is None
    spark.range(3).write.parquet(str(tmp_path / "north" / "feed" / "Pens.parquet"))
    assert ParquetSource(spark, str(tmp_path)).read("Pens", "feed", "north").count() == 3
    assert ParquetSource(spark, str(tmp_path)).read("Pens", "feed", "south") is None


def test_jdbc_options_split_large_tables(spark):
    source = JdbcSource(spark, {"main": "jdbc:x"}, {"user": "u"}, {"Costs": ("ID", 1, 1000, 16)})
    assert source.reader_options("Costs")["numPartitions"] == "16"
    assert "partitionColumn" not in source.reader_options("Pens")
    assert source.reader_options("Costs", "feed") is None and source.read("Costs", "feed") is None


def test_project_tolerant(spark):
    df = spark.createDataFrame([(1, "x")], "Id int, NAME string")
    out, missing = project_tolerant(df, {"ID": T.IntegerType(), "name": T.StringType(), "Phone": T.StringType()})
    assert missing == ["Phone"] and out.columns == ["ID", "name", "Phone"]
    assert out.first().asDict() == {"ID": 1, "name": "x", "Phone": None}


def test_raw_capture(spark):
    df = spark.sql("SELECT 1 AS `a b`, CAST(NULL AS STRING) AS t, X'616263' AS pic, timestamp'2024-01-02 03:04:05.678' AS at, 'é\"x' AS u")
    row = capture_raw(df, "Any").first()
    assert row["row_data"] == '{"a b":1,"t":null,"pic":"[BINARY 3 bytes]","at":"2024-01-02T03:04:05.678Z","u":"é\\"x"}'
    both = capture_raw_tables({"One": df, "Two": df.limit(0)})
    assert rows(both, "source_table", json_cell("row_data", "a b").alias("v")) == [("One", "1")]


def test_partitioned_sink_prunes_years(spark, tmp_path, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    path = str(tmp_path / "lines")
    by_year(lines, "l_shipdate", 1996, 1998).write.partitionBy("year").parquet(path)
    folders = sorted(d for d in os.listdir(path) if d.startswith("year="))
    assert folders == ["year=1996", "year=1997", "year=1998", "year=__default__"]
    kept = spark.read.parquet(path).where("year = '1997'")
    assert "PartitionFilters: [isnotnull(year" in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == lines.where(F.year("l_shipdate") == 1997).count()
    assert spark.read.parquet(path).count() == lines.count()


def test_unite_farms_and_presence(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2.5,)], "id double")
    assert rows(unite_farms({"a": a, "b": b}), "farm", "id", "name") == [("a", 1.0, "x"), ("b", 2.5, None)]
    report = schema_presence(spark, {"a": {"T": a.schema}, "b": {"T": b.schema}})
    assert rows(report, "column_name", "present_in", "farms", "types_seen") == [("id", 2, 2, "double,int"), ("name", 1, 2, "string")]


def test_views(spark):
    df = spark.createDataFrame([(1, "P")], "id int, name string")
    register_views({"cows": df, "pens_file": df}, {"pens_file": {"id": "pen_number_id"}})
    assert spark.table("cows").columns == ["id", "name"] and spark.table("pens_file").columns == ["pen_number_id"]


def test_unfinished_run_is_not_read(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path))
    good = spark.createDataFrame([(1, None, None, "good")], "id int, _reason string, _raw string, _disposition string")
    store.write(good, "a.b", "S", 5)
    assert store.read("a.b") is None and store.current_runs() == {}


def test_running_counts_follow_the_stream(spark, tmp_path):
    folder = tmp_path / "in"
    schema = "cow int, pen string, kind string"
    spark.createDataFrame([(1, "P1", "in"), (2, "P1", "in"), (3, "P2", "in")], schema).coalesce(1).write.parquet(str(folder / "a"))
    changes = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(folder))
    counts = running_counts(changes, "pen", F.col("kind") == "in", F.col("kind") == "out")
    batches = []
    query = (
        counts.writeStream.outputMode("update")
        .foreachBatch(lambda df, _: batches.append(rows(df, "pen", "members")))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .start()
    )
    try:
        query.processAllAvailable()
        spark.createDataFrame([(1, "P1", "out"), (4, None, "in")], schema).coalesce(1).write.parquet(str(folder / "b"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert [("P1", 2), ("P2", 1)] in batches and [("P1", 1)] in batches
