"""One user table over the staff lists of many farms. Passwords are never carried."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import synthetic_email, synthetic_username
from millrace.operators.joins import left_lookup
from millrace.operators.merge import upsert
from millrace.operators.rank import assign_ids, first_per_key

# Permission flags of the staff lists.
PERMISSIONS = (
    "cattle_data_entry",
    "cattle_reports",
    "cattle_utilities",
    "cattle_lookup_tables",
    "cattle_deletes",
    "feed_system_data_entry",
    "feed_system_reports",
    "feed_system_utilities",
    "pl_reports_allowed",
    "pen_rider",
)


def legacy_users(staff: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """All farms' staff keyed by (farm, user_id); staff rows replace what was there before."""
    carried = staff.drop(*[c for c in staff.columns if "password_hash" in c or c == "legacy_password"])
    order = [F.col(c).desc_nulls_last() for c in carried.columns if c not in ("farm", "user_id")]
    current = first_per_key(carried, ["farm", "user_id"], order)
    return current if existing is None else upsert(existing, current, ["farm", "user_id"])


def with_identity(staff: DataFrame) -> DataFrame:
    who = (F.col("firstname"), F.col("surname"), F.col("user_id"), F.col("farm"))
    return staff.withColumn("email", synthetic_email(*who)).withColumn("username", synthetic_username(*who))


def resolve_users(
    staff: DataFrame, users: DataFrame | None = None, permissions: Sequence[str] = PERMISSIONS
) -> tuple[DataFrame, DataFrame]:
    """(users, memberships): one user per email, known emails keep their id and row; one membership per farm and user."""
    known = with_identity(staff)
    firsts = first_per_key(known, ["email"], [F.col("farm").asc(), F.col("user_id").asc()])
    if users is not None:
        firsts = left_lookup(firsts, users.select("email"), ["email"], "left_anti")
    ids = assign_ids(known, users, ["email"], "id")
    fresh = left_lookup(firsts, ids, ["email"]).select(
        "id",
        "email",
        "username",
        F.col("firstname").alias("first_name"),
        F.col("surname").alias("last_name"),
        F.lit("user").alias("role"),
        F.col("finish_date").isNull().alias("active"),
    )
    everyone = fresh if users is None else users.unionByName(fresh, allowMissingColumns=True)
    flags = [c for c in permissions if c in staff.columns]
    member = left_lookup(known, ids, ["email"]).select(
        "farm", F.col("id").alias("member_id"), F.lit("stockman").alias("role"), F.col("user_id").alias("legacy_user_id"), *flags
    )
    return everyone, first_per_key(member, ["farm", "member_id"], [F.col("legacy_user_id").desc()])
