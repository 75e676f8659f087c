"""F: newest rows, unique names, numbering, assignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.history import latest_open
from millrace.operators.rank import assign_ids, disambiguate, first_per_key, number_rows, ranked_assignments
from millrace.plans.run import summary
from millrace.queries.registry import query


@query(
    "f1_latest_row",
    """SELECT o_custkey, o_orderdate, o_totalprice, o_orderkey FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey
                    ORDER BY o_orderdate DESC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey DESC) AS n FROM orders)
       WHERE n = 1""",
)
def latest_row(t):
    newest = [F.col(c).desc_nulls_last() for c in ("o_orderdate", "o_totalprice", "o_orderkey")]
    return first_per_key(t.orders.select("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey"), ["o_custkey"], newest)


@query(
    "f2_unique_names",
    """SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY upper(trim(p_name))) > 1
                              THEN trim(p_name) || ' (ID:' || p_partkey || ')' ELSE trim(p_name) END AS name
       FROM (SELECT p_partkey, p_name || CASE WHEN p_size > 20 THEN ' ' || p_brand || p_type ELSE '' END AS p_name FROM part)""",
)
def unique_names(t):
    longer = F.concat(F.lit(" "), "p_brand", "p_type")
    parts = t.part.select("p_partkey", F.concat("p_name", F.when(F.col("p_size") > 20, longer).otherwise("")).alias("p_name"))
    return disambiguate(parts, "p_name", "p_partkey", "name").select("p_partkey", "name")


@query(
    "f3_synthetic_code",
    "SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) + 20000 AS code FROM part",
)
def synthetic_code(t):
    return number_rows(t.part.select("p_name", "p_partkey"), ["p_name", "p_partkey"], "code", 20000).select("p_partkey", "code")


@query(
    "f4_ranked_assignments",
    """SELECT event_id, user_id, event_type = 'purchase' AND n = 1 AS active,
              CASE WHEN event_type <> 'purchase' THEN event_type WHEN n > 1 THEN 'dedup' END AS deactivated_reason
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                        ORDER BY (event_type = 'purchase') DESC, ts DESC NULLS LAST, event_id DESC) AS n
             FROM events WHERE user_id IS NOT NULL)""",
)
def assignments(t):
    events = t.events.select("event_id", "user_id", "event_type", "ts")
    ranked = ranked_assignments(events, "user_id", "event_id", "event_type", [F.col("ts").desc_nulls_last()], "purchase")
    return ranked.select("event_id", "user_id", "active", "deactivated_reason")


@query(
    "f5_latest_open",
    """SELECT o_custkey, is_open, started FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY is_open DESC, started DESC NULLS FIRST) AS n
         FROM (SELECT o_custkey, o_orderstatus = 'O' AS is_open,
                      CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS started FROM orders)) WHERE n = 1""",
)
def open_or_latest(t):
    spans = t.orders.select(
        "o_custkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("started"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("ended"),
    )
    latest = latest_open(spans, "o_custkey", "started", "ended")
    return latest.select("o_custkey", F.col("ended").isNull().alias("is_open"), "started")


@query(
    "f6_latest_log_row",
    """SELECT count(*) FILTER (WHERE event_type = 'purchase') AS ok, count(*) FILTER (WHERE event_type = 'error') AS failed,
              max(ts) AS last_completed
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1""",
)
def latest_log_row(t):
    status = F.when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed").otherwise("other")
    log = t.events.select(
        F.col("user_id").alias("source_table"),
        F.lit("events").alias("target_table"),
        F.col("event_id").alias("run_id"),
        status.alias("status"),
        F.col("ts").alias("completed_at"),
    )
    return summary(log).select("ok", "failed", "last_completed")


@query(
    "f7_surrogate_ids",
    """WITH have AS (SELECT s_name AS name, s_suppkey AS id FROM supplier),
            fresh AS (SELECT DISTINCT c_name AS name FROM customer WHERE c_name NOT IN (SELECT name FROM have))
       SELECT name, id FROM have
       UNION ALL SELECT name, row_number() OVER (ORDER BY name) + (SELECT max(id) FROM have) FROM fresh""",
)
def surrogate_ids(t):
    have = t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    wanted = t.customer.select(F.col("c_name").alias("name")).union(have.select("name"))
    return assign_ids(wanted, have, ["name"], "id")
