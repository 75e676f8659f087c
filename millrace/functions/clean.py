"""Cleaning functions for single cells, as Column expressions.

Every function takes a column and the Spark type it has in the source (text when left out), because the
same legacy column is text on one farm and typed on another. Nothing here raises on bad data: a cell that
cannot be read becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = T.StringType()
DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)

# The white space a text trim removes, and the number and date forms that are read.
WHITESPACE_CODES = [*range(0x09, 0x0E), 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B)]
WHITESPACE_CODES += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
WHITESPACE = "".join(chr(code) for code in WHITESPACE_CODES)
NUMBER_FORM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?Infinity$"
DAY_FIRST_FORM = r"^(\d{1,2})/(\d{1,2})/((?!00)\d{4})(?:[ T](\d{1,2}):(\d{2})(?::(\d{2}))?)?$"
HOUR_MINUTE = r"[ T]([01]?\d|2[0-3]):[0-5]\d"
ISO_FORM = r"^\d{4}(-\d{1,2}(-\d{1,2}([ T]\d{1,2}:\d{2}.*)?)?)?$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    return F.btrim(_column(value), F.lit(WHITESPACE))


def canonical_text(value: Column | str, dtype: T.DataType = TEXT) -> Column:
    """Text form of a cell that does not depend on how the number is stored: 5, 5.0 and 5.00 are all '5'."""
    c = _column(value)
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        whole = F.when(c == F.rint(c), c.try_cast("decimal(38,0)"))
        return F.coalesce(whole.cast("string"), c.cast("string"))
    if isinstance(dtype, T.DecimalType):
        text = c.cast("string")
        return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)
    return c.cast("string")


def trim_or_null(value: Column | str, dtype: T.DataType = TEXT) -> Column:
    text = F.replace(canonical_text(value, dtype), F.lit("\0"), F.lit(""))
    return F.nullif(trimmed(text), F.lit(""))


def to_bool(value: Column | str, dtype: T.DataType = TEXT) -> Column:
    c = _column(value)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(c != 0, F.lit(False))
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.upper(c).isin("1", "Y", "TRUE"), F.lit(False))
    return F.lit(False)


def to_binary(value: Column | str, dtype: T.DataType = TEXT) -> Column:
    if not isinstance(dtype, T.BinaryType):
        return F.lit(None).cast("binary")
    c = _column(value)
    return F.when(F.octet_length(c) > 0, c)


def to_num(value: Column | str, dtype: T.DataType = TEXT) -> Column:
    """Number or null. Blank text is 0, which the source systems rely on; not-a-number becomes null."""
    c = _column(value)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    if isinstance(dtype, T.NumericType):
        return c
    if isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(dtype, DATES):
        return F.unix_millis(c.cast("timestamp")).cast("double")
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("double")
    text = trimmed(c)
    return F.when(text == "", F.lit(0.0)).when(text.rlike(NUMBER_FORM), text.try_cast("double"))


def to_fk_id(value: Column | str, dtype: T.DataType = TEXT) -> Column:
    number = to_num(value, dtype)
    return F.when(number != 0, number)


def to_timestamp(value: Column | str, dtype: T.DataType = TEXT) -> Column:
    """Timestamp from a typed date, day-first text (checked against the calendar) or ISO text."""
    c = _column(value)
    if isinstance(dtype, DATES):
        return c.cast("timestamp")
    if isinstance(dtype, T.NumericType):
        # milliseconds; 0 stands for none, and past this bound there is no date
        return F.when((c != 0) & (F.abs(c) <= F.lit(8.64e15)), F.timestamp_millis(c.try_cast("long")))
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("timestamp")
    text = trimmed(c)

    def rewritten(form: str) -> Column:
        return F.regexp_replace(text, DAY_FIRST_FORM, form)

    midnight = rewritten("$3-$2-$1").try_cast("date").cast("timestamp")
    # minutes or seconds past 59 roll over within the day
    clock = F.split(rewritten("$4:$5:0$6"), ":")
    hours, minutes, seconds = (F.get(clock, F.lit(i)).try_cast("int") for i in range(3))
    passed = hours * 3600 + minutes * 60 + seconds
    rolled = F.timestamp_seconds(F.unix_seconds(midnight) + F.when(passed < 86400, passed))
    day_first = (
        F.when(~text.contains(":"), midnight)
        .when(text.rlike(HOUR_MINUTE + "$"), rewritten("$3-$2-$1 $4:$5:00").try_cast("timestamp"))
        .when(text.rlike(HOUR_MINUTE + r":[0-5]\d$"), rewritten("$3-$2-$1 $4:$5:$6").try_cast("timestamp"))
        .otherwise(rolled)
    )
    iso = F.when(text.rlike(ISO_FORM), text.try_cast("timestamp"))
    return F.when(text.contains("/"), F.when(text.rlike(DAY_FIRST_FORM), day_first)).otherwise(iso)


def to_time(value: Column | str, dtype: T.DataType = TEXT) -> Column:
    """HH:MM:SS from loosely written times such as 18.00 or 4;00."""
    text = trimmed(canonical_text(value, dtype))
    parts = F.filter(
        F.transform(F.split(F.regexp_replace(text, "[.;,]", ":"), ":"), trimmed), lambda p: p != ""
    )
    padded = F.transform(
        F.slice(F.concat(parts, F.array(F.lit("00"))), 1, 3),
        lambda p: F.when(F.length(p) < 2, F.lpad(p, 2, "0")).otherwise(p),
    )

    def within(index: int, top: int) -> Column:
        piece = F.get(padded, F.lit(index))
        return piece.rlike(r"^\d+$") & (piece.try_cast("int") <= top)

    ok = (F.size(parts) >= 2) & within(0, 23) & within(1, 59) & within(2, 59)
    return F.when(ok, F.array_join(padded, ":"))
