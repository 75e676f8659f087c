"""Legacy code tables as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import TEXT, canonical_text, to_bool, to_num, to_timestamp, trimmed

# Sex, weighing and contact codes of the source systems.
SEX = {"S": "steer", "M": "steer", "B": "bull", "C": "cow", "H": "heifer", "F": "heifer"}
WEIGH_TYPE = {1: "intake", 3: "exit", 4: "sale"}
CONTACT_TYPE_BY_ID = {
    2: "agistor",
    3: "vendor",
    4: "carrier",
    6: "buyer",
    7: "abattoir",
    8: "agent",
    10: "buyer",
    11: "customer-feeder",
}
CONTACT_TYPE_BY_NAME = [
    ("agistor", ["agist"], None),
    ("customer-feeder", ["custom", "feeder"], None),
    ("vendor", ["vendor"], "v"),
    ("agent", ["agent"], "a"),
    ("buyer", ["buyer"], "b"),
    ("abattoir", ["abattoir", "meatwork", "packer"], None),
    ("carrier", ["carrier", "transport"], None),
]
REVENUE_MARKS = ("+", "R")
# Fixed value: dates up to this day stand for "no date" in the source systems.
NO_DATE = "1901-01-01"


def _choose(key: Column, table: dict, default: str) -> Column:
    chain = None
    for code, label in table.items():
        test = key == F.lit(code)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(default)


def sex(value: Column, dtype: T.DataType = TEXT) -> Column:
    return _choose(trimmed(F.upper(canonical_text(value, dtype))), SEX, "heifer")


def weigh_type(value: Column, dtype: T.DataType = TEXT) -> Column:
    return _choose(to_num(value, dtype), WEIGH_TYPE, "interim")


def cost_type(value: Column, dtype: T.DataType = TEXT) -> Column:
    mark = F.upper(trimmed(canonical_text(value, dtype)))
    return F.when(mark.isin(*REVENUE_MARKS), "revenue").otherwise("expense")


def contact_type(value: Column, dtype: T.DataType = TEXT) -> Column:
    text = F.lower(trimmed(canonical_text(value, dtype)))
    number = to_num(value, dtype).cast("double")
    by_id = _choose(number, CONTACT_TYPE_BY_ID, "other")
    by_name = None
    for label, fragments, initial in CONTACT_TYPE_BY_NAME:
        test = text == initial if initial else F.lit(False)
        for fragment in fragments:
            test = test | text.contains(fragment)
        by_name = F.when(test, label) if by_name is None else by_name.when(test, label)
    return (
        F.when(text.isNull() | (text == ""), "other")
        .when(number == F.floor(number), by_id)
        .otherwise(by_name.otherwise("other"))
    )


def real_date(value: Column, dtype: T.DataType = TEXT) -> Column:
    """The date, or null where it is one of the early dates that stand for none."""
    stamp = to_timestamp(value, dtype)
    return F.when(stamp >= F.lit(NO_DATE).cast("timestamp"), stamp)


def lifecycle_status(
    died: Column,
    sale_date: Column,
    archived_date: Column,
    types: tuple[T.DataType, T.DataType, T.DataType] = (TEXT, TEXT, TEXT),
) -> Column:
    return (
        F.when(to_bool(died, types[0]), "died")
        .when(real_date(sale_date, types[1]).isNotNull(), "sold")
        .when(real_date(archived_date, types[2]).isNotNull(), "archived")
        .otherwise("active")
    )
