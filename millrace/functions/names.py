"""Name, key and identity helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.clean import _column, trimmed


def upper_name(value: Column | str) -> Column:
    return F.nullif(F.upper(trimmed(value)), F.lit(""))


def lower_name(value: Column | str) -> Column:
    return F.nullif(F.lower(trimmed(value)), F.lit(""))


def fallback_key(value: Column | str, row_id: Column | str, prefix: str = "LEGACY-") -> Column:
    """The key itself, or prefix + row id where it is blank."""
    c = _column(value)
    blank = F.coalesce(F.trim(c), F.lit("")) == ""
    return F.when(blank, F.concat(F.lit(prefix), _column(row_id).cast("string"))).otherwise(c)


def farm_slug(value: Column | str, limit: int = 63) -> Column:
    words = F.regexp_replace(F.lower(_column(value)), "&", "_and_")
    joined = F.regexp_replace(F.regexp_replace(words, "[^a-z0-9]+", "_"), "_+", "_")
    bare = F.regexp_replace(joined, "^_+|_+$", "")
    named = F.when(bare.rlike("^[a-z_]"), bare).otherwise(F.concat(F.lit("farm_"), bare))
    return F.when(F.length(named) > limit, F.regexp_replace(F.substring(named, 1, limit), "_+$", "")).otherwise(named)


def _person(first: Column, last: Column, drop: str, user_id: Column) -> Column:
    def part(name: Column) -> Column:
        return F.nullif(F.regexp_replace(F.lower(trimmed(name)), drop, ""), F.lit(""))

    name = F.concat_ws(".", part(first), part(last))
    return F.when(name == "", F.concat(F.lit("user"), user_id.cast("string"))).otherwise(name)


def synthetic_email(first: Column, last: Column, user_id: Column, farm: Column, domain: str = "legacy.invalid") -> Column:
    return F.concat(_person(first, last, r"\s+", user_id), F.lit("+"), farm, F.lit("@" + domain))


def synthetic_username(first: Column, last: Column, user_id: Column, farm: Column) -> Column:
    return F.concat(_person(first, last, "[^a-z0-9]+", user_id), F.lit("__"), farm)


def json_cell(row_json: Column | str, name: str) -> Column:
    return F.get_json_object(_column(row_json), f"$['{name}']")
