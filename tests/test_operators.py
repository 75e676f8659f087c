import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import history, joins, merge, quality, rank, resolve, shape


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with most rows, some missing keys, some rare ones, several input partitions."""
    data = [(i, 7 if i % 3 else None if i % 5 == 0 else i % 40) for i in range(900)]
    return spark.createDataFrame(data, "row int, k int").repartition(6)


def test_salted_join_equals_plain_join(spark, skewed):
    table = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40, 2)] + [(7, "hot")], "k int, v string")
    for how in ("left", "inner", "left_anti", "left_semi"):
        salted = joins.left_lookup(skewed, table, ["k"], how, sample=1.0, salted=True)
        plain = joins.left_lookup(skewed, table, ["k"], how, salted=False)
        assert salted.columns == plain.columns
        assert rows(salted, *salted.columns) == rows(plain, *plain.columns)


def test_salted_join_spreads_the_hot_key(spark, skewed):
    assert rows(joins.hot_keys(skewed, ["k"], limit=1, sample=1.0), "k") == [(7,)]
    table = spark.range(40).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("v"))
    with_threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
        assert not joins.fits_broadcast(table)
        joined = joins.left_lookup(skewed, table, ["k"], sample=1.0)
        assert "_salt" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 900
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_threshold)
    assert joins.fits_broadcast(table)


def test_size_settings():
    assert [joins._bytes(x) for x in ("10485760", "10485760b", "10mb", "1g", "-1", "2k")] == [
        10485760, 10485760, 10485760, 1 << 30, -1, 2048,
    ]


def test_flag_first(spark, skewed):
    flagged = rank.flag_first(skewed, ["k"], [F.col("row").desc()])
    got = rows(flagged.where("_first AND k IS NOT NULL"), "k", "row")
    best = {}
    for row, k in ((r["row"], r["k"]) for r in skewed.collect()):
        if k is not None:
            best[k] = max(best.get(k, -1), row)
    assert got == sorted(best.items(), key=str)
    assert flagged.count() == 900
    assert flagged.where("k IS NULL AND NOT _first").count() == 0


def test_flag_first_with_copies(spark):
    copies = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)], "k string, v int").repartition(5)
    flagged = rank.flag_first(copies, ["k"], [F.col("v")])
    assert rows(flagged.where("_first"), "k") == [("a",), ("b",)]


def test_first_per_key_is_cut_before_the_shuffle(skewed):
    first = rank.first_per_key(skewed, ["k"], [F.col("row")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert first.where("k = 7").collect()[0]["row"] == 1


def test_number_rows(spark, skewed):
    numbered = rank.number_rows(skewed, ["row"], "n", 100)
    assert rows(numbered, "row", "n") == sorted([(i, 101 + i) for i in range(900)], key=str)
    within = rank.number_rows(skewed.where("k IS NOT NULL"), ["row"], "n", 10, within=["k"])
    assert sorted(rows(within.where("k = 8"), "row", "n")) == [(48, 11), (168, 12), (288, 13), (408, 14), (528, 15), (648, 16), (768, 17), (888, 18)]
    assert within.groupBy("k").agg(F.min("n").alias("a"), (F.max("n") - F.count("n")).alias("b")).where("a <> 11 OR b <> 10").count() == 0
    copies = spark.createDataFrame([("x",)] * 300 + [("a",)], "v string").repartition(7)
    got = rows(rank.number_rows(copies, ["v"], "n"), "n", "v")
    assert sorted(n for n, _ in got) == list(range(1, 302))
    assert (1, "a") in got


def test_assign_ids_keeps_known(spark):
    known = spark.createDataFrame([("m", 5), ("z", 2)], "k string, id long")
    wanted = spark.createDataFrame([("a",), ("z",), ("q",), (None,), ("a",)], "k string")
    assert rows(rank.assign_ids(wanted, known, ["k"], "id"), "k", "id") == [("a", 6), ("m", 5), ("q", 7), ("z", 2)]


def test_disambiguate(spark):
    df = spark.createDataFrame([(1, " X "), (2, "x"), (3, None), (4, "Y"), (5, "")], "id int, n string")
    out = rank.disambiguate(df, "n", "id", "name", "Unknown", "Unknown Drug ")
    assert rows(out, "id", "name") == [(1, "X (ID:1)"), (2, "x (ID:2)"), (3, "Unknown Drug 3"), (4, "Y"), (5, "")]
    two = spark.createDataFrame([(1, None), (2, None)], "id int, n string")
    assert rows(rank.disambiguate(two, "n", "id", "name"), "name") == [("Unknown (ID:1)",), ("Unknown (ID:2)",)]


def test_ranked_assignments(spark):
    data = [(1, "A", "sold", 9), (2, "A", "active", 3), (3, "A", "active", 5), (4, "B", "died", 1), (5, "", "active", 1), (6, None, "active", 1)]
    df = spark.createDataFrame(data, "id int, tag string, status string, at int")
    out = rank.ranked_assignments(df, "tag", "id", "status", [F.col("at").desc_nulls_last()])
    assert rows(out, "id", "active", "deactivated_reason") == [
        (1, False, "sold"), (2, False, "dedup"), (3, True, None), (4, False, "died"),
    ]


def sequential_insert(batch, held, keys):
    """What inserting row after row and ignoring conflicts does."""
    taken = [set() for _ in keys]

    def parts(row):
        return [None if any(row[p] is None for p in key) else tuple(row[p] for p in key) for key in keys]

    for row in held:
        for seen, key in zip(taken, parts(row)):
            if key is not None:
                seen.add(key)
    accepted = []
    for row in batch:
        found = parts(row)
        if any(key is not None and key in seen for seen, key in zip(taken, found)):
            continue
        accepted.append(row["n"])
        for seen, key in zip(taken, found):
            if key is not None:
                seen.add(key)
    return sorted(accepted)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("keys", [[("a",)], [("a", "b")], [("a",), ("b",)]])
def test_conflicts_like_row_by_row_insert(spark, seed, keys):
    draw = random.Random(seed)
    make = lambda n: {"n": n, "a": draw.choice([None, *range(8)]), "b": draw.choice([None, *range(6)])}
    batch, held = [make(n) for n in range(40)], [make(n) for n in range(100, 104)]
    schema = "n int, a int, b int"
    frame = spark.createDataFrame(batch, schema).repartition(4)
    before = spark.createDataFrame(held, schema)
    marked = merge.mark_conflicts(frame, before, keys, [F.col("n")])
    assert marked.count() == 40
    got = [r["n"] for r in marked.where("NOT _conflict").collect()]
    assert sorted(got) == sequential_insert(batch, held, keys)
    added = merge.insert_ignoring(frame, before, keys, [F.col("n")])
    assert sorted(r["n"] for r in added.collect()) == sequential_insert(batch, held, keys)


def test_conflicts_among_copies(spark):
    copies = spark.createDataFrame([(1, 2)] * 30, "a int, b int").repartition(5)
    marked = merge.mark_conflicts(copies, None, [("a",), ("b",)], [F.col("a")])
    assert marked.where("NOT _conflict").count() == 1 and marked.count() == 30


def test_partial_unique_key(spark):
    df = spark.createDataFrame([(1, "x 1", "active"), (2, "x1", "active"), (3, "x1", "sold")], "n int, eid string, status string")
    unique = (("replace(eid, ' ', '')",), "status = 'active'")
    kept = merge.insert_ignoring(df, None, [unique], [F.col("n")])
    assert rows(kept, "n") == [(1,), (3,)]


def test_upsert_takes_the_last_update_with_its_nulls(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "old", 1), (2, None, 2), (3, "c", 1)], "k int, v string, at int")
    out = merge.upsert(old, new, ["k"], [F.col("at").desc()])
    assert rows(out, "k", "v") == [(1, "a"), (2, None), (3, "c")]


def test_resolve(spark):
    parents = spark.createDataFrame([(10, 1, "P01"), (11, 10, " p02 "), (12, None, None)], "id int, legacy int, name string")
    df = spark.createDataFrame([(1, 1, "p01"), (2, 10, "P02 "), (3, 99, ""), (4, None, None)], "row int, ref int, pen string")
    assert rows(resolve.converge_keys(df, "ref", parents, "id", "legacy"), "row", "ref") == [(1, 10), (2, 10), (3, None), (4, None)]
    named = resolve.remap_by_name(df, "pen", parents, "name", "id", "pen_id")
    assert rows(named, "row", "pen_id") == [(1, 10), (2, 11), (3, None), (4, None)]
    assert rows(resolve.null_unknown(df, ["ref"], parents, "legacy"), "row", "ref") == [(1, 1), (2, 10), (3, None), (4, None)]
    assert rows(resolve.orphans(df, "ref", parents, "legacy"), "row") == [(3,)]
    fresh = resolve.missing_parents(df, F.concat("pen", F.lit("x")), parents, "name", "id")
    assert rows(fresh, "name", "id") == [("P02 x", 13), ("p01x", 14), ("x", 15)]
    filled = resolve.fill_nulls(
        spark.createDataFrame([(1, None), (2, "kept")], "k int, v string"),
        spark.createDataFrame([(1, "new"), (2, "other")], "k int, v string"),
        "k",
        ["v"],
    )
    assert rows(filled, "k", "v") == [(1, "new"), (2, "kept")]


def test_unpivot_skips_absent_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, None, 7.0)], "k int, data0 double, DATA2 double")
    out = shape.unpivot_slots(df, "k", shape.numbered_columns("DATA{}", 0, 3))
    assert rows(out, "k", "slot", "value") == [(1, 0, 5.0), (2, 2, 7.0)]


def test_header_steps_skip_existing(spark):
    data = [(1, 2, 10, 1.0, None), (1, None, 99, 2.0, True), (2, 1, 10, 3.0, False), (9, 1, 10, 4.0, False), (None, 1, 10, 5.0, False)]
    steps = spark.createDataFrame(data, "parent int, day int, item int, dose double, by_weight boolean")
    parents = spark.createDataFrame([(100, 1, " One "), (200, 2, "Two")], "id int, disease_id int, disease_name string")
    items = spark.createDataFrame([(7, 10)], "id int, drug_id int")
    existing = spark.createDataFrame([(200,)], "parent_id int")
    headers, made, unmatched = shape.split_header_steps(steps, parents, items, existing)
    assert rows(headers, "parent_id", "name", "days", "by_weight") == [(100, "One", 2, True)]
    assert rows(made, "parent_id", "day_number", "item_id", "dose") == [(100, 0, None, 2.0), (100, 1, 7, 1.0), (200, 0, 7, 3.0)]
    assert rows(unmatched, "parent", "dose") == [(9, 4.0), (None, 5.0)]


def test_history(spark):
    moves = spark.createDataFrame([(1, "d1", 5, "P5"), (1, "d1", 5, "P5"), (1, "d2", 5, "P5"), (None, "d1", 5, "P5")], "cow int, day string, pen_id int, pen string")
    old = spark.createDataFrame([(1, "d2", None, "P5", "entry")], "cow int, day string, pen_id int, pen string, reason string")
    out = history.mirror_moves(moves, old, "cow", "day", "pen_id", "pen")
    assert rows(out, "cow", "day", "pen_id", "reason") == [(1, "d1", 5, "move"), (1, "d2", None, "entry")]
    again = history.mirror_moves(moves, out, "cow", "day", "pen_id", "pen")
    assert again.count() == 2
    numbered = out.withColumn("id", F.monotonically_increasing_id())
    back = history.undo_moves(numbered, moves.limit(1), "cow", "day", "pen_id", "id")
    assert rows(back, "day", "reason") == [("d2", "entry")]


def test_current_assignments(spark):
    data = [(1, "c1", "T1", "active"), (2, "c1", "T2", "active"), (3, "c2", "T3", "active"), (4, "c2", "T3", "sold"),
            (5, "c3", "T4", "active"), (6, "c3", None, "active"), (7, "c4", "T5", "active")]
    events = spark.createDataFrame(data, "n int, cow string, tag string, status string")
    out = history.current_assignments(events, "cow", "tag", "status", [F.col("n").desc()])
    assert rows(out, "cow", "tag", "active", "reason") == [
        ("c1", "T1", False, "retag"), ("c1", "T2", True, None), ("c2", "T3", False, "sold"),
        ("c3", "T4", False, "untagged"), ("c4", "T5", True, None),
    ]


def test_quality(spark):
    empty = spark.createDataFrame([], "k int, v string")
    assert rows(quality.null_rates(empty), "column_name", "null_pct") == [("k", None), ("v", None)]
    assert quality.duplicate_summary(quality.duplicate_groups(empty, ["k"])).first().asDict() == {"duplicate_groups": 0, "excess_rows": 0}
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "c")], "k int, v string")
    assert rows(quality.duplicate_groups(df, ["k"]), "k", "row_count") == [(1, 2)]
    ratio = quality.fill_ratio(df, F.lit(True), F.col("k")).first()
    assert (ratio["fill_ratio"], ratio["passed"], ratio["distinct_values"]) == (0.5, True, 1)
