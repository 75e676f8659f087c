"""How a column is cleaned, by the name of its kind."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import clean, codes

# Fixed value: event dates that are missing get this day, which partitioned targets need.
MISSING_EVENT_DATE = "1900-01-01"


def _keep(c: Column, dtype: T.DataType) -> Column:
    return c


def _inverted(c: Column, dtype: T.DataType) -> Column:
    return ~clean.to_bool(c, dtype)


def _event_date(c: Column, dtype: T.DataType) -> Column:
    return F.coalesce(clean.to_timestamp(c, dtype), F.lit(MISSING_EVENT_DATE).cast("timestamp"))


def _not_negative(c: Column, dtype: T.DataType) -> Column:
    number = clean.to_num(c, dtype)
    return F.when(number >= 0, number)


def _record_number(c: Column, dtype: T.DataType) -> Column:
    number = clean.to_num(c, dtype)
    return F.when(~number.isin(0, -1), number)


def _num_or_one(c: Column, dtype: T.DataType) -> Column:
    return F.coalesce(clean.to_num(c, dtype), F.lit(1))


KINDS: dict[str, Callable[[Column, T.DataType], Column]] = {
    "keep": _keep,
    "text": clean.trim_or_null,
    "num": clean.to_num,
    "bool": clean.to_bool,
    "not_bool": _inverted,
    "date": clean.to_timestamp,
    "time": clean.to_time,
    "binary": clean.to_binary,
    "fk": clean.to_fk_id,
    "event_date": _event_date,
    "real_date": codes.real_date,
    "not_negative": _not_negative,
    "record_number": _record_number,
    "num_or_one": _num_or_one,
    "sex": codes.sex,
    "weigh_type": codes.weigh_type,
    "cost_type": codes.cost_type,
    "contact_type": codes.contact_type,
}


#: What a kind reads its cells as; kinds that are not named here are given the text as it stands.
READ_AS = {
    **dict.fromkeys(("num", "fk", "not_negative", "record_number", "num_or_one"), "num"),
    **dict.fromkeys(("bool", "not_bool"), "bool"),
    **dict.fromkeys(("date", "event_date", "real_date"), "date"),
}

# Texts that a flag is written as.
FLAG_TEXTS = ("1", "0", "Y", "N", "TRUE", "FALSE")


def unread(c: Column, kind: str) -> Column:
    """Whether a text cell says something that its reading as a number, date or flag would lose."""
    lost = ~F.upper(c).isin(*FLAG_TEXTS) if kind == "bool" else KINDS[kind](c, T.StringType()).isNull()
    return F.coalesce((clean.trimmed(c) != "") & lost, F.lit(False))


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return "text"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.NumericType):
        return "num"
    if isinstance(dtype, clean.DATES):
        return "date"
    if isinstance(dtype, T.BinaryType):
        return "binary"
    return "keep"
