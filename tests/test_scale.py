"""What plans look like, and operators whose way depends on the keys: conflicts, lookups, checks, comparisons, runs."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import components, joins, merge, resolve
from millrace.plans import reports
from millrace.plans.checks import ReferenceCheck, RowCheck, UniqueCheck, compiled
from millrace.plans.run import chains, run, unbalanced
from millrace.plans.table_plan import plan, source_kind
from millrace.sources import TargetStore, declared_schemas, read_declared, unite_farms
from millrace.sources.readers import missing_table
from millrace.spec import Reference, TableSpec, Unique
from tests.test_operators import sequential_insert


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- conflicts under several keys ---


@pytest.mark.parametrize("most", [100_000, 50])
def test_chain_of_a_thousand_rows(spark, most):
    """Each row shares a key with the next; where components are small, rounds break the chain up until they are."""
    n = 1000 if most > 1000 else 56
    batch = [{"n": i, "a": i // 2, "b": (i + 1) // 2} for i in range(n)]
    df = spark.createDataFrame(batch, "n int, a int, b int").repartition(4)
    marked = merge.mark_conflicts(df, None, [("a",), ("b",)], [F.col("n")], most=most)
    assert sorted(r.n for r in marked.where("NOT _conflict").collect()) == sequential_insert(batch, [], [("a",), ("b",)])


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_components_settle_as_row_by_row(spark, seed):
    draw = random.Random(seed)
    batch = [{c: draw.choice([None, *range(40)]) for c in "abc"} | {"n": i} for i in range(150)]
    df = spark.createDataFrame(batch, "n int, a int, b int, c int").repartition(4)
    keys = [("a",), ("b", "c"), ("c",)]
    marked = merge.mark_conflicts(df, None, keys, [F.col("n")], most=60)
    assert sorted(r.n for r in marked.where("NOT _conflict").collect()) == sequential_insert(batch, [], keys)


def test_connected(spark):
    draw = random.Random(1)
    pairs = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)]
    label = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in label:
        for a, b in pairs:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components.connected(spark.createDataFrame(pairs, "a long, b long"))
    assert rows(got, "node", "root") == sorted(label.items(), key=str)


# --- one join for each parent ---


def referring(spark, tmp_path, columns, parent_rows=50):
    draw = random.Random(6)
    spark.range(parent_rows).select(F.col("id").alias("legacy"), (F.col("id") * 10).alias("id")).write.parquet(f"{tmp_path}/parents")
    parents = spark.read.parquet(f"{tmp_path}/parents")
    data = [tuple(draw.choice([None, 7, draw.randrange(80)]) for _ in columns) for _ in range(300)]
    return parents, spark.createDataFrame(data, ", ".join(f"{c} long" for c in columns)), data


def test_many_references_to_one_parent_are_one_join(spark, tmp_path, without_broadcast):
    columns = [f"contact{i}" for i in range(14)]
    parents, child, data = referring(spark, tmp_path, columns)
    spec = TableSpec("S", "t.t", references=tuple(Reference(c, "p", "legacy", "id") for c in columns))
    out = plan(spec, child, reader={"p": parents}.get).good
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [legacy") == 1
    want = sorted((tuple(None if v is None or v >= 50 else 10 * v for v in r) for r in data), key=str)
    assert rows(out, *columns) == want


def test_two_columns_of_one_source_column_are_one_join(spark, tmp_path, without_broadcast):
    parents, child, data = referring(spark, tmp_path, ["BeastID"])
    refs = tuple(Reference(c, "p", "legacy", "id", required=c == "beastid", also="cow_id") for c in ("beastid", "beast_id"))
    spec = TableSpec("S", "t.t", mirror={"BeastID": ("beast_id",)}, references=refs)
    out = plan(spec, child, reader={"p": parents}.get)
    assert out.good._jdf.queryExecution().optimizedPlan().toString().count("Relation [legacy") == 1
    kept = [v for (v,) in data if v is None or v < 50]
    assert rows(out.good, "beastid", "beast_id", "cow_id") == sorted(((v and v * 10,) * 3 if v != 0 else (0,) * 3 for v in kept), key=str)


def test_null_unknown_without_broadcast(spark, tmp_path, without_broadcast):
    ids, df, data = referring(spark, tmp_path, ["a", "b", "c"])
    out = resolve.null_unknown(df, ["a", "b", "c"], ids, "legacy")
    assert out.columns == ["a", "b", "c"]
    assert rows(out, "a", "b", "c") == sorted((tuple(None if v is None or v >= 50 else v for v in r) for r in data), key=str)


def test_salts_follow_the_share_of_a_key(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 10 == 1, 2).otherwise(F.col("id")).alias("k"), F.lit("f").alias("farm"))
        found = joins.heavy_keys(df, joins.sketched(df, {"k": ["k"]}, 1.0), "k", ["k"])
        assert rows(found, "k", "_salts") == [(1, 40), (2, 8)]
        two = joins.heavy_keys(df, joins.sketched(df, {"k": ["farm", "k"]}, 1.0), "k", ["farm", "k"])
        assert rows(two, "farm", "k", "_salts") == [("f", 1, 40), ("f", 2, 8)]
        empty = df.limit(0)
        assert joins.heavy_keys(empty, joins.sketched(empty, {"k": ["k"]}, 1.0), "k", ["k"]).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


# --- checks and comparisons ---


def test_checks_read_a_table_twice_at_most(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 30).alias("p"), (F.col("id") % 7).cast("double").alias("q")).write.parquet(f"{tmp_path}/c")
    spark.range(25).select(F.col("id").cast("string").alias("key")).write.parquet(f"{tmp_path}/p")
    child, parent = spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/p")
    again = spark.read.parquet(f"{tmp_path}/c")
    checks = [
        RowCheck("small", child, F.col("id") > 97),
        RowCheck("set", again, F.col("id").isNull()),
        UniqueCheck("ids", again, ("id",)),
        UniqueCheck("parts", child, ("p", F.col("id") % 2), F.col("id") < 60),
        ReferenceCheck("p", child, "p", parent, "key"),
        ReferenceCheck("q", again, "q", parent, "key"),
    ]
    out = compiled(checks)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [id") == 2
    assert {r["check"]: r["detail"] for r in out.collect()} == {
        "small": "failing rows: 2", "set": "failing rows: 0", "ids": "duplicate keys: 0", "parts": "duplicate keys: 30",
        "p": "orphaned rows: 15", "q": "orphaned rows: 0",
    }
    nothing = compiled([UniqueCheck("none", child.limit(0), ("id",)), ReferenceCheck("no", child.limit(0), "p", parent, "key")])
    assert rows(nothing, "check", "passed") == [("no", True), ("none", True)]


def test_comparison_meets_only_what_differs(spark):
    a = spark.range(5000).select("id", F.col("id").cast("string").alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 4321, "other").otherwise(F.col("v"))).where("id <> 17")
    out = reports.diff(a, b, "id", "id", {"v": "v"})
    assert rows(out, "key", "kind", "target_value") == [("17", "missing", None), ("4321", "field", "other")]
    assert "SortAggregate" not in final_plan(out)
    assert reports.diff(a, a.union(a), "id", "id", {"v": "v"}).count() == 0
    assert reports.diff(a, a, "id", "id", {}).count() == 0


# --- declared kinds ---


def test_declared_schemas_from_what_a_database_lists(spark):
    listed = [
        ("core", "t", "n", "numeric", 2, 10, 2, "NO"), ("core", "t", "id", "integer", 1, None, None, "YES"),
        ("core", "t", "at", "time without time zone", 3, None, None, "YES"), ("core", "u", "x", "character varying", 1, None, None, "YES"),
    ]
    kinds = "table_schema string, table_name string, column_name string, data_type string, ordinal_position int"
    columns = spark.createDataFrame(listed, f"{kinds}, numeric_precision int, numeric_scale int, is_nullable string")

    class Listing:
        def read(self, table, group="main", farm=None):
            return columns if table == "information_schema.columns" else None

    found = read_declared(Listing())
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in found["core.t"]] == [
        ("id", "int", True), ("n", "decimal(10,2)", False), ("at", "string", True),
    ]
    assert found["core.u"]["x"].dataType == T.StringType() and found == declared_schemas(columns)
    out = plan(TableSpec("T", "core.t"), spark.createDataFrame([("5", "1.5", "7;05"), ("x", None, "7")], "ID string, N string, At string"), declared=found["core.t"])
    assert [tuple(map(str, r)) for r in out.good.collect()] == [("5", "1.50", "07:05:00")]
    assert rows(out.rejected, "reason") == [("rule:required n",)]


def test_no_cell_of_a_mixed_column_is_lost(spark):
    a = spark.createDataFrame([("abc", "1", "Y", "x")], "Code string, Amount string, Flag string, Note string")
    b = spark.createDataFrame([(5, 2.5, True, 7)], "Code int, Amount double, Flag boolean, Note int")
    united = unite_farms({"a": a, "b": b}, {"note": "text"}.get)
    assert rows(united, "farm", "Code", "Amount", "Flag", "Note") == [("a", "abc", 1.0, True, "x"), ("b", "5", 2.5, True, "7")]
    spec = TableSpec("S", "t.t", mirror={"Amount": ("amount_text",)})
    declared = T.StructType.fromDDL("code int, amount double, amount_text string")
    assert [source_kind(spec, declared, c) for c in ("Code", "Amount", "Flag")] == ["num", "text", None]


def test_names_say_nothing(spark):
    df = spark.createDataFrame([("soon", "yes", "heavy")], "Purchase_Date string, Is_Open string, Weight string")
    out = plan(TableSpec("S", "t.t"), df).good
    assert [tuple(r) for r in out.collect()] == [("soon", "yes", "heavy")]


class Cause:
    """A chain of Java exceptions, as far as it is looked at."""

    def __init__(self, name, state=None, code=0, cause=None):
        self.name, self.state, self.code, self.cause = name, state, code, cause

    def getClass(self):
        methods = ["getSQLState"] if self.state is not None else ["getMessage"]
        return type("Kind", (), {"getMethods": lambda _: [type("M", (), {"getName": lambda _, n=n: n})() for n in methods], "getSimpleName": lambda _: self.name})()

    def getSQLState(self):
        return self.state

    def getErrorCode(self):
        return self.code

    def getCause(self):
        return self.cause


def test_only_a_missing_table_is_a_missing_table():
    def failing(cause):
        error = RuntimeError('database "x" does not exist: not found')
        error._origin = cause
        return error

    assert missing_table(failing(Cause("AnalysisException", cause=Cause("PSQLException", "42P01"))))
    assert missing_table(failing(Cause("SQLServerException", "S0002", 208)))
    assert not missing_table(failing(Cause("PSQLException", "3D000")))
    assert not missing_table(failing(Cause("UnknownHostException"))) and not missing_table(failing(None))


# --- runs ---


def loaded(spark, frames, folder, parallel, dry_run=False):
    tables = {(f"T{i}", "main"): spark.createDataFrame([(k, f"2021-0{1 + k % 9}-01") for k in range(20 + i)], "ID int, Day string") for i in range(6)}
    specs = [TableSpec(f"T{i}", "t.same" if i < 2 else f"t.t{i}", order=10 if i < 5 else 20, unique=(Unique(("legacy_id",)),), rename={"ID": "legacy_id"}) for i in range(6)]
    specs.append(TableSpec("T0", "t.broken", order=10, derive={"x": lambda df: df["no such column"]}))
    store = TargetStore(spark, str(folder))
    return run(spark, specs, frames(tables), store, run_id=5, parallel=parallel, dry_run=dry_run, raw_tables=["T0", "None"]), store


def test_side_by_side_gives_the_log_of_one_by_one(spark, frames, tmp_path):
    plain = ["source_table", "target_table", "status", "rows_read", "rows_written", "rows_conflict"]
    one, store = loaded(spark, frames, tmp_path / "one", 1)
    many, _ = loaded(spark, frames, tmp_path / "many", 4)
    assert [tuple(r) for r in one.select(plain).collect()] == [tuple(r) for r in many.select(plain).collect()]
    assert rows(one, *plain) == rows(store.log(), *plain) and unbalanced(one).isEmpty()
    assert rows(one.where("target_table = 't.same'"), *plain[3:]) == [(20, 20, 0), (21, 1, 20)]
    assert [tuple(r) for r in one.where("status = 'failed'").select("target_table").collect()] == [("t.broken",)]
    dry, nothing = loaded(spark, frames, tmp_path / "dry", 4, dry_run=True)
    assert rows(dry, *plain) == rows(one, *plain) and nothing.log() is None


def test_chains():
    specs = [TableSpec("A", "t.a"), TableSpec("B", "t.b"), TableSpec("C", "t.a"), TableSpec("D", "t.d", references=(Reference("x", "t.b", "k"),)), TableSpec("E", "t.e")]
    assert chains(specs) == [[0, 2], [1, 3], [4]]


def test_a_raw_table_that_fails_leaves_the_run_alone(spark, tmp_path):
    class Broken:
        def read(self, table, group="main", farm=None):
            raise RuntimeError("no such host")

    log = run(spark, [], Broken(), TargetStore(spark, str(tmp_path)), raw_tables=["R"])
    assert rows(log, "source_table", "status", "error_details") == [("R", "failed", "no such host")]


def test_years_of_a_target_are_pruned(spark, frames, tmp_path):
    days = [(i, f"{2018 + i % 6}-03-04") for i in range(60)] + [(99, None)]
    source = frames({("Events", "main"): spark.createDataFrame(days, "No int, Day string").withColumn("Day", F.col("Day").cast("date"))})
    store = TargetStore(spark, str(tmp_path))
    log = run(spark, [TableSpec("Events", "t.events", years=("day", 2020, 2022))], source, store, run_id=1)
    assert rows(log, "rows_read", "rows_written") == [(61, 61)]
    part = store.read("t.events", years=(2021, 2021)).where("year(day) = 2021")
    assert part.count() == 10 and "_year" not in part.columns
    text = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "_year" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert store.read("t.events").count() == 61
