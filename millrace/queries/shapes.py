"""J: unpivoting, header and steps, movement history, current state."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.history import current_assignments, mirror_moves, undo_moves
from millrace.operators.shape import split_header_steps, unpivot_slots
from millrace.queries.registry import query


@query(
    "j1_unpivot_sizes",
    """SELECT p_partkey, 1 AS slot, CAST(p_size AS DOUBLE) AS value FROM part WHERE p_size <= 40
       UNION ALL SELECT p_partkey, 2, p_retailprice FROM part""",
)
def unpivot_sizes(t):
    parts = t.part.select("p_partkey", F.when(F.col("p_size") <= 40, F.col("p_size")).alias("M1"), F.col("p_retailprice").alias("M2"))
    return unpivot_slots(parts, "p_partkey", {"M1": 1, "M2": 2, "M3": 3})


@query(
    "j2_unpivot_measures",
    """SELECT slot, count(*) AS row_count, min(value) AS low, max(value) AS high FROM (
         SELECT 0 AS slot, l_quantity AS value FROM lineitem UNION ALL SELECT 1, l_extendedprice FROM lineitem
         UNION ALL SELECT 2, l_discount FROM lineitem WHERE l_discount > 0 UNION ALL SELECT 3, l_tax FROM lineitem) GROUP BY 1""",
)
def unpivot_measures(t):
    lines = t.lineitem.withColumn("l_discount", F.when(F.col("l_discount") > 0, F.col("l_discount")))
    slots = {"l_quantity": 0, "l_extendedprice": 1, "l_discount": 2, "l_tax": 3}
    long = unpivot_slots(lines, "l_orderkey", slots)
    return long.groupBy("slot").agg(F.count(F.lit(1)).alias("row_count"), F.min("value").alias("low"), F.max("value").alias("high"))


def _split(t):
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("parent"),
        F.col("l_linenumber").alias("day"),
        F.col("l_partkey").alias("item"),
        F.col("l_quantity").alias("dose"),
        (F.col("l_returnflag") == "R").alias("by_weight"),
    )
    parents = t.orders.where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("disease_id"),
        (F.col("o_orderkey") + 1000000).alias("id"),
        F.col("o_orderpriority").alias("disease_name"),
    )
    items = t.part.where("p_size <= 40").select(F.col("p_partkey").alias("drug_id"), (F.col("p_partkey") + 5).alias("id"))
    existing = t.orders.where("o_orderstatus = 'F'").select((F.col("o_orderkey") + 1000000).alias("parent_id"))
    return split_header_steps(rows, parents, items, existing)


@query(
    "j3_headers",
    """SELECT l_orderkey + 1000000 AS parent_id, max(o_orderpriority) AS name, max(l_linenumber) AS days,
              bool_or(l_returnflag = 'R') AS by_weight
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O' GROUP BY 1""",
)
def step_headers(t):
    return _split(t)[0]


@query(
    "j3_steps",
    """SELECT l_orderkey + 1000000 AS parent_id, greatest(l_linenumber - 1, 0) AS day_number, p_partkey + 5 AS item_id,
              l_quantity AS dose
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P'
       LEFT JOIN part ON p_partkey = l_partkey AND p_size <= 40""",
)
def steps(t):
    return _split(t)[1]


@query(
    "j3_unmatched",
    """SELECT l_orderkey AS parent, l_linenumber AS day, l_partkey AS item, l_quantity AS dose, l_returnflag = 'R' AS by_weight
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P'""",
)
def unmatched(t):
    return _split(t)[2]


PLACED = """SELECT event_id, user_id, CAST(ts AS DATE) AS day, CAST(floor(value / 50) AS BIGINT) AS place_id,
                   'pen ' || CAST(floor(value / 50) AS BIGINT) AS place, event_type FROM events"""


def _placed(t):
    place_id = F.floor(F.col("value") / 50)
    return t.events.select(
        "event_id",
        "user_id",
        F.to_date("ts").alias("day"),
        place_id.alias("place_id"),
        F.concat(F.lit("pen "), place_id.cast("string")).alias("place"),
        "event_type",
    )


@query(
    "j4_mirror_moves",
    f"""WITH p AS ({PLACED}), h AS (SELECT * FROM p WHERE event_type = 'view')
        SELECT user_id, day, place_id, place, NULL AS reason FROM h
        UNION ALL SELECT DISTINCT user_id, day, place_id, place, 'move' FROM p WHERE event_type = 'purchase' AND NOT EXISTS (
          SELECT 1 FROM h WHERE h.user_id = p.user_id AND h.day = p.day AND h.place_id = p.place_id)""",
)
def mirrored(t):
    placed = _placed(t)
    columns = ("user_id", "day", "place_id", "place")
    history = placed.where("event_type = 'view'").select(*columns, F.lit(None).cast("string").alias("reason"))
    moves = placed.where("event_type = 'purchase'").select(*columns)
    return mirror_moves(moves, history, "user_id", "day", "place_id", "place")


@query(
    "j4_undo_moves",
    f"""WITH p AS ({PLACED}),
             m AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, place_id ORDER BY event_id) AS n FROM p WHERE event_type = 'click'),
             u AS (SELECT user_id, day, place_id, count(*) AS k FROM p WHERE event_type = 'error' GROUP BY 1, 2, 3)
        SELECT event_id, user_id, place_id FROM m LEFT JOIN u USING (user_id, day, place_id) WHERE n > coalesce(k, 0)
        UNION ALL SELECT event_id, user_id, place_id FROM p WHERE event_type = 'view'""",
)
def undone(t):
    placed = _placed(t)
    reason = F.when(F.col("event_type") == "click", "move")
    history = placed.where("event_type IN ('click', 'view')").withColumn("reason", reason)
    left = undo_moves(history, placed.where("event_type = 'error'"), "user_id", "day", "place_id", "event_id")
    return left.select("event_id", "user_id", "place_id")


@query(
    "j5_current_assignments",
    """WITH e AS (SELECT event_id, user_id, CASE event_type WHEN 'view' THEN 'T1' WHEN 'click' THEN 'T2' WHEN 'purchase' THEN 'T3' END AS tag,
                         CASE WHEN event_type = 'error' THEN 'sold' ELSE 'active' END AS status FROM events),
            l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM e) WHERE n = 1)
       SELECT p.user_id, p.tag, l.status = 'active' AND coalesce(l.tag = p.tag, FALSE) AS active,
              CASE WHEN l.status <> 'active' THEN l.status WHEN l.tag IS NULL THEN 'untagged' WHEN l.tag <> p.tag THEN 'retag' END AS reason
       FROM (SELECT DISTINCT user_id, tag FROM e WHERE tag IS NOT NULL AND status = 'active') p JOIN l ON l.user_id = p.user_id""",
)
def current_state(t):
    tag = F.when(F.col("event_type") == "view", "T1").when(F.col("event_type") == "click", "T2").when(F.col("event_type") == "purchase", "T3")
    status = F.when(F.col("event_type") == "error", "sold").otherwise("active")
    changes = t.events.select("event_id", "user_id", tag.alias("tag"), status.alias("status"))
    return current_assignments(changes, "user_id", "tag", "status", [F.col("event_id").desc()])
