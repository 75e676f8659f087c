"""K and L: quality and comparison reports, users over many farms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import left_lookup
from millrace.plans import reports, users
from millrace.plans.checks import RowCheck, UniqueCheck
from millrace.plans.reports import ForeignKey
from millrace.plans.table_plan import outcome, plan
from millrace.queries.registry import query
from millrace.session import durable
from millrace.spec import Reference, TableSpec


@query(
    "k1_profile",
    """WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 4000 THEN c_acctbal END AS c_acctbal FROM customer),
            o AS (SELECT o_custkey, o_orderdate, o_totalprice FROM orders)
       SELECT 'customer' AS table_name, count(*) AS row_count,
              CASE WHEN (count(*) - count(c_acctbal)) * 100.0 / count(*) > 30 THEN 'c_acctbal' ELSE '' END AS high_null_columns,
              0::BIGINT AS duplicate_groups, 0::BIGINT AS excess_rows, '' AS date_ranges,
              CASE WHEN (count(*) - count(c_acctbal)) * 100.0 / count(*) > 30 THEN 'WARN' ELSE 'PASS' END AS status FROM c
       UNION ALL SELECT 'orders', (SELECT count(*) FROM o), '',
              (SELECT count(*) FROM (SELECT 1 FROM o GROUP BY o_custkey HAVING count(*) > 1)),
              (SELECT sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM o GROUP BY o_custkey HAVING count(*) > 1)),
              'o_orderdate ' || strftime(min(o_orderdate), '%Y-%m-%d') || ' ' || strftime(max(o_orderdate), '%Y-%m-%d'), 'FAIL' FROM o""",
)
def profile(t):
    customer = t.customer.select("c_custkey", "c_name", F.when(F.col("c_acctbal") >= 4000, F.col("c_acctbal")).alias("c_acctbal"))
    orders = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    meta = {"customer": ("c_custkey", ()), "orders": ("o_custkey", ("o_orderdate",))}
    return reports.profile_all({"customer": customer, "orders": orders}, meta)


def _fk_sql(child, column, parent, key, where):
    return f"""SELECT '{child}.{column} -> {parent}.{key}' AS foreign_key, count(*) AS total,
        count(*) FILTER (WHERE {column} NOT IN (SELECT {key} FROM {parent} WHERE {where})) AS orphans FROM {child}"""


@query(
    "k2_fk_audit",
    "SELECT *, round(orphans * 100.0 / total, 2)::DOUBLE AS orphan_pct, CASE WHEN orphans * 100.0 / total > 5 THEN 'FAIL' WHEN orphans > 0 "
    "THEN 'WARN' ELSE 'PASS' END AS status FROM ("
    + " UNION ALL ".join(
        [
            _fk_sql("lineitem", "l_orderkey", "orders", "o_orderkey", "o_totalprice > 20000"),
            _fk_sql("lineitem", "l_partkey", "part", "p_partkey", "p_size <= 40"),
            _fk_sql("lineitem", "l_suppkey", "supplier", "s_suppkey", "TRUE"),
            _fk_sql("orders", "o_custkey", "customer", "c_custkey", "TRUE"),
            _fk_sql("customer", "c_nationkey", "nation", "n_nationkey", "TRUE"),
        ]
    )
    + ")",
)
def fk_audit(t):
    tables = {
        "lineitem": t.lineitem,
        "orders": t.orders,
        "customer": t.customer,
        "supplier": t.supplier,
        "nation": t.nation,
        "part": t.part.where("p_size <= 40"),
    }
    keys = (
        ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
        ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
        ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
    )
    large = {**tables, "orders": t.orders.where("o_totalprice > 20000")}
    first = reports.fk_audit(large, [ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey")])
    out = first.union(reports.fk_audit(tables, keys))
    return out.withColumn("orphan_pct", F.col("orphan_pct").cast("double"))


COVERED = {"nation": "mapped", "region": "raw", "orders": "mapped", "lineitem": "mapped", "customer": "mapped"}
COUNTED = ("nation", "region", "orders", "lineitem", "customer", "documents", "events")


@query(
    "k3_coverage",
    "SELECT table_name, row_count, strategy, CASE WHEN strategy = 'uncategorised' THEN 'uncategorised' "
    "WHEN table_name = 'region' THEN 'category_conflict' END AS issue FROM (SELECT *, CASE table_name WHEN 'region' THEN 'raw' "
    "WHEN 'documents' THEN 'excluded' WHEN 'events' THEN 'uncategorised' ELSE 'mapped' END AS strategy FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED)
    + "))",
)
def coverage(t):
    counts = [
        getattr(t, n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n in COUNTED
    ]
    named = t.spark.createDataFrame(sorted(COVERED.items()), "table_name string, strategy string")
    tables = reduce(DataFrame.union, counts)
    return reports.coverage(tables, named, [("(?i)^DOC", "excluded")], ["nation", "region", "orders"])


@query(
    "k5_load_checks",
    """WITH k AS (SELECT l.*, o.o_orderkey FROM lineitem l LEFT JOIN orders o ON o_orderkey = l_orderkey AND o_orderstatus <> 'P'),
            good AS (SELECT * FROM k WHERE o_orderkey IS NOT NULL AND l_quantity > 2)
       SELECT 'row count: lineitem -> core.lines' AS "check", TRUE AS passed,
              'read ' || count(*) || ', accounted ' || count(*) AS detail FROM k
       UNION ALL SELECT 'foreign key: core.lines.l_orderkey -> core.orders.id', TRUE, 'orphaned rows: 0'
       UNION ALL SELECT 'foreign key: core.lines.l_suppkey -> core.suppliers.s_suppkey', count(*) = 0, 'orphaned rows: ' || count(*)
         FROM good WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
       UNION ALL SELECT 'order_id filled: core.lines', TRUE, 'rows without it: 0'""",
)
def load_checks(t):
    known = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", (F.col("o_orderkey") * 10).alias("id"))
    spec = TableSpec(
        "lineitem",
        "core.lines",
        order=40,
        references=(Reference("l_orderkey", "core.orders", "o_orderkey", "id", required=True, also="order_id"),),
        validate="l_quantity > 2",
    )
    planned = plan(spec, t.lineitem, reader={"core.orders": known}.get)
    # as in a load: checks read what was written
    planned.frame = durable(planned.frame)
    read = t.lineitem.agg(F.count(F.lit(1)).alias("rows_read"))
    log = reports._side_by_side(outcome(planned.frame), read).select(
        "*", F.lit("lineitem").alias("source_table"), F.lit("core.lines").alias("target_table"),
        F.lit("completed").alias("status"), F.lit(0).cast("long").alias("rows_deduped"),
    )
    tables = {"core.lines": planned.good, "core.orders": known, "core.suppliers": t.supplier.where("s_acctbal > 0")}
    keys = (
        ForeignKey("core.lines", "l_orderkey", "core.orders", "id"),
        ForeignKey("core.lines", "l_suppkey", "core.suppliers", "s_suppkey"),
    )
    return reports.all_checks(
        [
            reports.count_checks(log),
            *reports.fk_checks(tables, keys),
            *reports.filled_checks(tables, [("core.lines", "l_orderkey", "order_id")]),
        ]
    )


@query(
    "k6_quality_rules",
    """WITH bad AS (SELECT count(*) AS n FROM events WHERE event_type IS NULL OR event_type = ''),
            one AS (SELECT count(*) AS n FROM (SELECT 1 FROM events WHERE event_type = 'purchase' GROUP BY user_id HAVING count(*) > 1)),
            eid AS (SELECT count(*) AS n FROM (SELECT 1 FROM part WHERE p_size > 10 GROUP BY replace(p_name, ' ', '') HAVING count(*) > 1)),
            cost AS (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey, l_returnflag HAVING count(*) > 1)),
            neg AS (SELECT count(*) AS n FROM customer WHERE c_acctbal < 0),
            zero AS (SELECT count(*) AS n FROM supplier WHERE s_nationkey = 0)
       SELECT 'no empty tags' AS "check", n = 0 AS passed, 'failing rows: ' || n AS detail FROM bad
       UNION ALL SELECT 'one active holder', n = 0, 'duplicate keys: ' || n FROM one
       UNION ALL SELECT 'unique electronic ids', n = 0, 'duplicate keys: ' || n FROM eid
       UNION ALL SELECT 'one row per cost group', n = 0, 'duplicate keys: ' || n FROM cost
       UNION ALL SELECT 'no negative weights', n = 0, 'failing rows: ' || n FROM neg
       UNION ALL SELECT 'no zero vendors', n = 0, 'failing rows: ' || n FROM zero""",
)
def quality_rules(t):
    squeezed = F.replace("p_name", F.lit(" "), F.lit("")).alias("eid")
    return reports.all_checks(
        [
            RowCheck("no empty tags", t.events, F.col("event_type").isNull() | (F.col("event_type") == "")),
            UniqueCheck("one active holder", t.events, ("user_id",), F.col("event_type") == "purchase"),
            UniqueCheck("unique electronic ids", t.part, (squeezed,), F.col("p_size") > 10),
            UniqueCheck("one row per cost group", t.lineitem, ("l_orderkey", "l_partkey", "l_returnflag")),
            RowCheck("no negative weights", t.customer, F.col("c_acctbal") < 0),
            RowCheck("no zero vendors", t.supplier, F.col("s_nationkey") == 0),
        ]
    )


@query(
    "k8_loaded_checks",
    """SELECT 'events loaded' AS "check", TRUE AS passed, 'source ' || count(*) || ', target '
              || count(*) FILTER (WHERE event_type = 'view') AS detail FROM events
       UNION ALL SELECT 'lookups loaded', FALSE, 'source ' || ((SELECT count(*) FROM orders) + (SELECT count(*) FROM customer)) || ', target 0'""",
)
def loaded_checks(t):
    none = t.events.where(F.col("event_type") == "no such type")
    return reports.all_checks(
        [
            reports.loaded_check("events loaded", [t.events], t.events.where("event_type = 'view'")),
            reports.loaded_check("lookups loaded", [t.orders, t.customer], none),
        ]
    )


@query(
    "k9_reconcile",
    """SELECT 'orders' AS table_name, count(*) AS source_rows, count(*) FILTER (WHERE o_orderstatus <> 'P') AS target_rows,
              count(*) FILTER (WHERE o_orderstatus = 'P') AS delta, count(*) FILTER (WHERE o_orderstatus = 'P') = 0 AS "match" FROM orders
       UNION ALL SELECT 'customer', count(*), count(*), 0, TRUE FROM customer
       UNION ALL SELECT 'absent', 0, 0, 0, TRUE
       UNION ALL SELECT 'lineitem', count(*), 0, count(*), FALSE FROM lineitem""",
)
def reconcile(t):
    return reports.reconcile(
        {
            "orders": (t.orders, t.orders.where("o_orderstatus <> 'P'")),
            "customer": (t.customer, t.customer),
            "absent": (None, None),
            "lineitem": (t.lineitem, None),
        }
    )


@query(
    "k10_table_diff",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, 'field' AS kind, 'name' AS field, c_name AS source_value,
              upper(c_name) AS target_value FROM customer WHERE c_acctbal < 0 AND c_mktsegment <> 'BUILDING'
       UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'field', 'nation', CAST(c_nationkey AS VARCHAR), ''
         FROM customer WHERE c_nationkey > 20 AND c_mktsegment <> 'BUILDING'
       UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'missing', NULL, NULL, NULL FROM customer WHERE c_mktsegment = 'BUILDING'
       UNION ALL SELECT CAST(-1 - s_suppkey AS VARCHAR), 'extra', NULL, NULL, NULL FROM supplier""",
)
def table_diff(t):
    copy = t.customer.where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") < 0, F.upper("c_name")).otherwise(F.concat(F.lit(" "), "c_name")).alias("name"),
        F.when(F.col("c_nationkey") <= 20, F.col("c_nationkey").cast("double")).alias("nation"),
    )
    extra = t.supplier.select((F.lit(-1) - F.col("s_suppkey")).alias("id"), F.col("s_name"), F.col("s_nationkey").cast("double"))
    return reports.diff(t.customer, copy.union(extra), "c_custkey", "id", {"c_name": "name", "c_nationkey": "nation"})


def _staff(t):
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.lower("n_name").alias("farm"))
    return left_lookup(t.customer, nation, ["c_nationkey"]).select(
        "farm",
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("firstname"),
        F.lit("Lee").alias("surname"),
        F.lit("secret").alias("password_hash"),
        F.when(F.col("c_acctbal") > 5000, F.lit("2024-01-01").cast("date")).alias("finish_date"),
        (F.col("c_acctbal") > 1000).alias("pen_rider"),
    )


STAFF = """SELECT lower(n_name) AS farm, c_custkey AS user_id, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS firstname, 'Lee' AS surname,
                  CASE WHEN c_acctbal > 5000 THEN DATE '2024-01-01' END AS finish_date, c_acctbal > 1000 AS pen_rider
           FROM customer JOIN nation ON n_nationkey = c_nationkey"""


@query(
    "l1_legacy_users",
    f"""SELECT * FROM ({STAFF}) UNION ALL
        SELECT lower(n_name), -1 - s_suppkey, s_name, 'Old', NULL, FALSE FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
)
def legacy_users(t):
    staff = _staff(t)
    nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.lower("n_name").alias("farm"))
    old = t.supplier.join(nation, "s_nationkey").select(
        "farm", (F.lit(-1) - F.col("s_suppkey")).alias("user_id"), F.col("s_name").alias("firstname"), F.lit("Old").alias("surname"),
        F.lit(None).cast("date").alias("finish_date"), F.lit(False).alias("pen_rider"),
    )
    stale = staff.drop("password_hash").withColumn("surname", F.lit("Stale")).where(F.col("pen_rider"))
    return users.legacy_users(staff, stale.unionByName(old))


PEOPLE = f"""WITH staff AS ({STAFF}),
    s AS (SELECT *, concat_ws('.', lower(firstname), 'lee') || '+' || farm || '@legacy.invalid' AS email,
                 concat_ws('.', lower(firstname), 'lee') || '__' || farm AS username FROM staff),
    ids AS (SELECT email, row_number() OVER (ORDER BY email) AS id FROM (SELECT DISTINCT email FROM s))"""


@query(
    "l2_users",
    PEOPLE
    + """ SELECT id, email, username, firstname AS first_name, surname AS last_name, 'user' AS role, finish_date IS NULL AS active
          FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY farm, user_id) AS n FROM s) JOIN ids USING (email) WHERE n = 1""",
)
def resolved_users(t):
    return users.resolve_users(_staff(t))[0]


@query(
    "l2_memberships",
    PEOPLE
    + """ SELECT farm, id AS member_id, 'stockman' AS role, user_id AS legacy_user_id, pen_rider
          FROM (SELECT *, row_number() OVER (PARTITION BY farm, email ORDER BY user_id DESC) AS n FROM s) JOIN ids USING (email) WHERE n = 1""",
)
def memberships(t):
    return users.resolve_users(_staff(t))[1]



@query(
    "k4_spec_check",
    """WITH c AS (SELECT 'c_name' AS column_name, count(c_name) AS cells, NULL::VARCHAR AS problem, 0::BIGINT AS lost FROM customer
                  UNION ALL SELECT 'c_acctbal', count(c_acctbal), 'lost_cells', count(*) FILTER (WHERE c_custkey % 3 = 0) FROM customer
                  UNION ALL SELECT 'c_custkey', count(*), NULL, 0 FROM customer
                  UNION ALL SELECT 'c_nationkey', count(c_nationkey), NULL, 0 FROM customer
                  UNION ALL SELECT 'c_mktsegment', count(c_mktsegment), 'unknown_column', 0 FROM customer)
       SELECT 'customer' AS source_table, 'core.customers' AS target_table, column_name, cells, lost, problem FROM c
       WHERE problem IS NOT NULL""",
)
def spec_check(t):
    """Target columns the declared target lacks, and cells its kinds cannot take, with how many cells that concerns."""
    balance = F.when(F.col("c_custkey") % 3 == 0, "unknown").otherwise(F.col("c_acctbal").cast("string"))
    source = t.customer.withColumn("c_acctbal", balance)
    declared = T.StructType.fromDDL("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double")
    spec = TableSpec("customer", "core.customers")
    return reports.spec_problems(t.spark, [(spec, source)], {"core.customers": declared})
