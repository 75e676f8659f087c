from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalogue import PATTERNS, PROFILE_META, SPECS, STALE_COLUMNS, STRANDED_PAIRS, category_frame
from millrace.catalogue.categories import categories
from millrace.operators.quality import stranded_columns
from millrace.plans import reports, users
from millrace.plans.table_plan import plan, rejected_samples, target_columns
from millrace.sources.sinks import LOG_SCHEMA
from millrace.plans.run import summary, unbalanced
from millrace.spec import TableSpec, select_specs, target_name
from tests.farm import build


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_catalogue_shape():
    assert (len(SPECS), len({s.source for s in SPECS}), len({s.target for s in SPECS})) == (197, 195, 167)
    assert len({(s.source, s.target) for s in SPECS}) == 197
    assert sorted({s.order for s in SPECS}) == [10, 15, 20, 30, 39, 40, 50]
    assert {s.database for s in SPECS} == {"main", "feed", "feedtrans"}
    assert not any("pass" in name.lower() for s in SPECS for name in s.rename)


def test_specs_write_each_target_column_once(spark):
    for (name, group), df in build(spark).items():
        for spec in (s for s in SPECS if s.source == name and s.database == group):
            names = list(target_columns(spec, df.schema))
            assert len(names) == len(set(names)) and names


def test_target_name():
    assert target_name("Ohead_$/Hd/Day") == "ohead_hd_day"
    assert target_name("ExpiryDate") == "expirydate" and target_name("ExpiryDate", True) == "expiry_date"
    assert target_name("Dressing % From") == "dressing_from"


def test_select_specs():
    assert [s.source for s in select_specs(SPECS, ["CATTLE"])] == ["Cattle"]
    assert len(select_specs(SPECS, None)) == 197 and select_specs(SPECS, ["nothing"]) == []


def test_declared_schema_decides_the_kind(spark):
    spec = TableSpec("S", "t.t")
    declared = T.StructType([T.StructField("flag", T.BooleanType()), T.StructField("n", T.IntegerType()), T.StructField("d", T.DateType())])
    df = spark.createDataFrame([("Y", "7", "3/4/2024"), ("N", "x", "bad")], "Flag string, N string, D string")
    out = plan(spec, df, declared=declared).good
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in declared.fields]
    assert [str(tuple(r)) for r in out.collect()] == ["(True, 7, datetime.date(2024, 4, 3))", "(False, None, None)"]
    report = reports.check_specs(spark, [spec], lambda s: ["flag", "zzz"], {"t.t": declared})
    assert rows(report, "column_name", "problem") == [("zzz", "unknown_column")]


def test_coverage_of_the_catalogue(spark):
    assert set(categories().values()) == {"mapped", "raw", "excluded"}
    tables = spark.createDataFrame(
        [("Cattle", 7), ("NewUnknownTable", 10), ("Pen_DOF", 1), ("BatchUpdate_Keyfile_Me", 2), ("Pen_mort_morb_list", 3)],
        "table_name string, row_count long",
    )
    report = reports.coverage(tables, category_frame(spark), PATTERNS, [s.source for s in SPECS])
    assert rows(report, "table_name", "strategy", "issue") == [
        ("BatchUpdate_Keyfile_Me", "excluded", None),
        ("Cattle", "mapped", None),
        ("NewUnknownTable", "uncategorised", "uncategorised"),
        ("Pen_DOF", "raw", None),
        ("Pen_mort_morb_list", "mapped", None),
    ]
    assert rows(reports.coverage_totals(report), "strategy", "table_count", "issues") == [
        ("excluded", 1, 0), ("mapped", 2, 0), ("raw", 1, 0), ("uncategorised", 1, 1),
    ]


def test_profile_of_core_tables(spark):
    tables = {name: df for (name, _), df in build(spark).items() if name in ("Cattle", "Diseases", "Breeds")}
    meta = {n: (k, [d for d in dates if d in tables[n].columns and d != "Sale_Date"]) for n, (k, dates) in PROFILE_META.items() if n in tables}
    report = reports.profile_all(tables, meta)
    assert rows(report, "table_name", "status", "row_count", "duplicate_groups", "excess_rows") == [
        ("Breeds", "PASS", 4, 0, 0), ("Cattle", "FAIL", 7, 1, 1), ("Diseases", "PASS", 4, 0, 0),
    ]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "k int, v string")
    report = reports.profile(empty, "t", "k").first()
    assert (report["status"], report["row_count"]) == ("PASS", 0)
    fk = reports.fk_audit({"c": empty, "p": empty}, [reports.ForeignKey("c", "k", "p", "k")]).first()
    assert (fk["status"], fk["orphan_pct"], fk["total"]) == ("PASS", 0.0, 0)


def test_negative_weight_fails(spark):
    df = spark.createDataFrame([(-1.0,), (5.0,)], "weight double")
    row = reports.rule_check("no negative weights", df, F.col("weight") < 0).first()
    assert (row["passed"], row["detail"]) == (False, "failing rows: 1")


def test_stranded_and_stale(spark):
    cows = spark.createDataFrame([(300.0, None, 1)], "start_weight double, start_weight_kg double, breed int")
    assert rows(stranded_columns(cows, STRANDED_PAIRS), "old_column", "stranded") == [("start_weight", True)]
    assert reports.stale_columns(cows, STALE_COLUMNS) == ["start_weight", "breed"]


def test_diff_covers_all_keys(spark):
    a = spark.createDataFrame([(i, float(i)) for i in range(700)], "k int, v double")
    b = a.withColumn("v", F.when(F.col("k") >= 650, F.lit(-1.0)).otherwise(F.col("v"))).where("k <> 3")
    out = reports.diff(a, b, "k", "k", {"v": "v"})
    assert out.where("kind = 'field'").count() == 50
    assert rows(out.where("kind <> 'field'"), "key", "kind") == [("3", "missing")]


def test_samples_are_capped_and_counts_are_not(spark):
    quarantine = spark.createDataFrame([("t", "junk", str(i)) for i in range(60)], "target_table string, reason string, row_data string")
    assert rejected_samples(quarantine).count() == 25


def log_frame(spark, *entries):
    def row(**values):
        return tuple(values.get(f.name) for f in LOG_SCHEMA.fields)

    return spark.createDataFrame([row(**e) for e in entries], LOG_SCHEMA)


def test_log_reports(spark):
    log = log_frame(
        spark,
        dict(run_id=1, source_table="A", target_table="x", status="failed"),
        dict(run_id=2, source_table="A", target_table="x", status="completed", rows_read=5, rows_written=4, rows_junk=1),
        dict(run_id=1, source_table="A", target_table="y", status="failed"),
        dict(run_id=2, source_table="B", target_table="x", status="completed", rows_read=5, rows_written=6),
    )
    assert summary(log).first().asDict() | {"last_completed": None} == {"ok": 2, "failed": 1, "running": 0, "last_completed": None}
    assert rows(unbalanced(log), "source_table") == [("B",)]
    checks = reports.all_checks([reports.count_checks(log)])
    assert rows(checks, "check", "passed") == [("row count: A -> x", True), ("row count: B -> x", False)]


def test_users_of_many_farms(spark):
    schema = "farm string, user_id int, firstname string, surname string, password_hash string, finish_date date, pen_rider boolean"
    staff = spark.createDataFrame(
        [("n", 1, "Ann", "Lee", "s", None, True), ("n", 2, "ann ", "LEE", "s", None, False), ("s", 1, None, " ", "s", None, None)],
        schema,
    )
    legacy = users.legacy_users(staff)
    assert "password_hash" not in legacy.columns and legacy.count() == 3
    people, members = users.resolve_users(staff)
    assert rows(people, "id", "email", "username") == [
        (1, "ann.lee+n@legacy.invalid", "ann.lee__n"), (2, "user1+s@legacy.invalid", "user1__s"),
    ]
    assert rows(members, "farm", "member_id", "legacy_user_id", "pen_rider") == [("n", 1, 2, False), ("s", 2, 1, None)]
    later = spark.createDataFrame([("m", 1, "Abe", "Old", "s", None, True)], schema)
    again, _ = users.resolve_users(reduce(DataFrame.unionByName, [staff, later]), people)
    assert rows(again, "id", "email") == [
        (1, "ann.lee+n@legacy.invalid"), (2, "user1+s@legacy.invalid"), (3, "abe.old+m@legacy.invalid"),
    ]
