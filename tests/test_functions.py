from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import functions as fn
from millrace.functions.kinds import KINDS, kind_of


def results(spark, function, values, dtype=None):
    dtype = dtype or T.StringType()
    rows = [(i, v) for i, v in enumerate(values)]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", dtype)])
    df = spark.createDataFrame(rows, schema).select("i", function(F.col("v"), dtype).alias("out"))
    return [r["out"] for r in df.orderBy("i").collect()]


def test_to_bool(spark):
    assert results(spark, fn.to_bool, ["y", "Y", "TRUE", "true", "1", "X", "", None, " Y "]) == [True] * 5 + [False] * 4
    assert results(spark, fn.to_bool, [0, 1, -1, None], T.IntegerType()) == [False, True, True, False]
    assert results(spark, fn.to_bool, [True, False, None], T.BooleanType()) == [True, False, False]
    assert results(spark, fn.to_bool, [datetime(2024, 1, 1)], T.TimestampType()) == [False]


def test_trim_or_null(spark):
    blank = chr(0xA0) + chr(0x3000) + "\t\n"
    values = ["has\0nulls", "   ", "", None, f"{blank}kept{blank}", blank, "a b", "\0"]
    assert results(spark, fn.trim_or_null, values) == ["hasnulls", None, None, None, "kept", None, "a b", None]
    assert results(spark, fn.trim_or_null, [123, None], T.IntegerType()) == ["123", None]
    assert results(spark, fn.trim_or_null, [5.0, 2.5], T.DoubleType()) == ["5", "2.5"]


def test_to_num(spark):
    values = ["", "  ", "abc", "3.14", " 42 ", "1e3", ".5", "5.", "+7", "5d", "1,000", None, "NaN", "-0.5"]
    expected = [0.0, 0.0, None, 3.14, 42.0, 1000.0, 0.5, 5.0, 7.0, None, None, None, None, -0.5]
    assert results(spark, fn.to_num, values) == expected
    assert results(spark, fn.to_num, [float("nan"), 1.5, None], T.DoubleType()) == [None, 1.5, None]
    assert results(spark, fn.to_num, [9007199254740993], T.LongType()) == [9007199254740993]
    assert results(spark, fn.to_num, [True, False], T.BooleanType()) == [1.0, 0.0]


def test_to_fk_id(spark):
    assert results(spark, fn.to_fk_id, ["0", "", "7", None]) == [None, None, 7.0, None]
    assert results(spark, fn.to_fk_id, [0, 7, None], T.IntegerType()) == [None, 7, None]


def test_to_timestamp(spark):
    values = [
        "15/01/2024",
        "1/2/2024 4:05",
        "1/2/2024 04:05:06",
        "31/02/2024",
        "1/1/2024 25:00",
        "1/1/2024 23:75",
        "2024-03-04",
        "2024-03-04T05:06:07Z",
        "12:30",
        "rubbish",
        "",
        None,
    ]
    expected = [
        datetime(2024, 1, 15),
        datetime(2024, 2, 1, 4, 5),
        datetime(2024, 2, 1, 4, 5, 6),
        None,
        None,
        None,
        datetime(2024, 3, 4),
        datetime(2024, 3, 4, 5, 6, 7),
        None,
        None,
        None,
        None,
    ]
    assert results(spark, fn.to_timestamp, values) == expected
    # minutes past 59 roll over within the day
    assert results(spark, fn.to_timestamp, ["1/1/2024 10:75"]) == [datetime(2024, 1, 1, 11, 15)]


def test_typed_dates(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05' AS a, date'2024-01-02' AS b, 0 AS c, 1000 AS d")
    out = df.select(*[fn.to_timestamp(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]).first()
    assert list(out) == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2), None, datetime(1970, 1, 1, 0, 0, 1)]
    assert kind_of(df.schema["a"].dataType) == "date"
    assert results(spark, fn.to_timestamp, [float("nan"), 1e300, 1000.0, 0.0], T.DoubleType()) == [
        None, None, datetime(1970, 1, 1, 0, 0, 1), None,
    ]
    assert results(spark, fn.trim_or_null, [float("nan"), 1e300, -0.5], T.DoubleType()) == ["NaN", "1.0E300", "-0.5"]


def test_to_time(spark):
    values = ["18.00", "4;00", "14:30", "14:30:15", "24:00", "9", "", None, "10,15", "1:2:3", ":5:", "aa:00"]
    expected = ["18:00:00", "04:00:00", "14:30:00", "14:30:15", None, None, None, None, "10:15:00", "01:02:03", None, None]
    assert results(spark, fn.to_time, values) == expected


def test_to_binary(spark):
    assert results(spark, fn.to_binary, [b"ab", b"", None], T.BinaryType()) == [b"ab", None, None]
    assert results(spark, fn.to_binary, ["ab"]) == [None]


def test_codes(spark):
    assert results(spark, fn.sex, ["S", "m", " B ", "C", "H", "F", "Z", None, ""]) == [
        "steer", "steer", "bull", "cow", "heifer", "heifer", "heifer", "heifer", "heifer",
    ]
    assert results(spark, fn.weigh_type, [1, 2, 3, 4, 9, None], T.IntegerType()) == [
        "intake", "interim", "exit", "sale", "interim", "interim",
    ]
    assert results(spark, fn.cost_type, ["+", " r ", "-", "E", None]) == ["revenue", "revenue", "expense", "expense", "expense"]


def test_contact_type(spark):
    values = ["2", "3", "11", "4.5", "Packer", "V", "a", "Custom feeding", "Animal Buyer", "1", "", None, "Transport Co", "zzz"]
    expected = [
        "agistor", "vendor", "customer-feeder", "other", "abattoir", "vendor", "agent", "customer-feeder",
        "buyer", "other", "other", "other", "carrier", "other",
    ]
    assert results(spark, fn.contact_type, values) == expected


def test_lifecycle_status(spark):
    rows = [
        (0, "Y", "2024-01-01", "2024-01-01"),
        (1, "N", "2024-01-01", "2024-01-01"),
        (2, "N", None, "2024-01-01"),
        (3, "N", "1900-01-01", None),
        (4, "N", "1901-01-01", None),
        (5, None, None, None),
    ]
    df = spark.createDataFrame(rows, "i int, died string, sale string, archived string")
    out = df.select("i", fn.lifecycle_status(F.col("died"), F.col("sale"), F.col("archived")).alias("s")).orderBy("i")
    assert [r["s"] for r in out.collect()] == ["died", "sold", "archived", "active", "sold", "active"]


def test_names(spark):
    df = spark.createDataFrame(
        [(1, " J & B Farms! ", "Ann  Marie", "O'Neil"), (2, "2DE", None, " "), (3, "x" * 80, "", "Lee")],
        "user_id int, farm string, first string, last string",
    )
    who = (F.col("first"), F.col("last"), F.col("user_id"))
    out = df.select(
        fn.farm_slug("farm").alias("slug"),
        fn.synthetic_email(*who, F.lit("f")).alias("email"),
        fn.synthetic_username(*who, F.lit("f")).alias("username"),
        fn.fallback_key(F.lit("  "), "user_id").alias("key"),
    ).collect()
    assert [r["slug"] for r in out] == ["j_and_b_farms", "farm_2de", "x" * 63]
    assert [r["email"] for r in out] == ["annmarie.o'neil+f@legacy.invalid", "user2+f@legacy.invalid", "lee+f@legacy.invalid"]
    assert [r["username"] for r in out] == ["annmarie.oneil__f", "user2__f", "lee__f"]
    assert out[0]["key"] == "LEGACY-1"


@pytest.mark.parametrize("dtype", ["string", "double", "int", "boolean", "timestamp", "timestamp_ntz", "binary", "decimal(19,4)"])
def test_null_never_fails(spark, dtype):
    df = spark.createDataFrame([(None,)], f"v {dtype}")
    df.select(*[f(F.col("v"), df.schema["v"].dataType).alias(kind) for kind, f in KINDS.items()]).collect()


def test_kind_of():
    assert kind_of(T.DecimalType(19, 4)) == "num"
    assert kind_of(T.ArrayType(T.StringType())) == "keep"


def test_timestamp_edges(spark):
    values = ["1/1/2024 9:30", "1/1/0050", "1/1/2024T23:59:59", "1/1/2024 00:00:75", "1/1/2024 23:59:75", "2024-01-01 10:20", "2024"]
    expected = [
        datetime(2024, 1, 1, 9, 30),
        None,
        datetime(2024, 1, 1, 23, 59, 59),
        datetime(2024, 1, 1, 0, 1, 15),
        None,
        datetime(2024, 1, 1, 10, 20),
        datetime(2024, 1, 1),
    ]
    assert results(spark, fn.to_timestamp, values) == expected
