"""A: scans, sources, sinks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import json_cell
from millrace.operators.merge import insert_ignoring, upsert
from millrace.operators.quality import null_rates
from millrace.plans.run import run
from millrace.plans.table_plan import plan, source_kind
from millrace.queries.registry import query
from millrace.session import ensure_checkpoint_dir
from millrace.sources import ParquetSource, TargetStore, by_year, capture_raw, project_tolerant, register_views, unite_farms
from millrace.spec import Reference, TableSpec


@query("a1_table_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def table_scan(t):
    orders = ParquetSource(t.spark, t.folder).read("orders")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(
    "a3_tolerant_projection",
    "SELECT c_custkey, c_name AS C_NAME, CAST(NULL AS VARCHAR) AS c_phone FROM customer",
)
def tolerant_projection(t):
    wanted = {"c_custkey": T.LongType(), "C_NAME": T.StringType(), "c_phone": T.StringType()}
    return project_tolerant(t.customer, wanted)[0]


@query(
    "a4_raw_capture",
    """SELECT 'orders' AS source_table, CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS status,
              strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS ordered_at
       FROM orders""",
)
def raw_capture(t):
    return capture_raw(t.orders, "orders").select(
        "source_table",
        json_cell("row_data", "o_orderkey").alias("order_key"),
        json_cell("row_data", "o_orderstatus").alias("status"),
        json_cell("row_data", "o_orderdate").alias("ordered_at"),
    )


@query(
    "a8_range_partitions",
    """SELECT CASE WHEN year(l_shipdate) BETWEEN 1996 AND 2000 THEN CAST(year(l_shipdate) AS VARCHAR)
                   ELSE '__default__' END AS year, count(*) AS row_count
       FROM lineitem GROUP BY 1""",
)
def range_partitions(t):
    parts = by_year(t.lineitem, "l_shipdate", 1996, 2000)
    return parts.groupBy("year").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "a9_insert_ignoring",
    """SELECT user_id, event_type, event_id FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n
         FROM events e
         WHERE NOT EXISTS (SELECT 1 FROM events h WHERE h.event_type = 'view' AND h.value > 50
                             AND h.user_id = e.user_id AND h.event_type = e.event_type))
       WHERE n = 1""",
)
def insert_ignoring_conflicts(t):
    events = t.events
    held = events.where("event_type = 'view' AND value > 50")
    added = insert_ignoring(events, held, [("user_id", "event_type")], [F.col("ts"), F.col("event_id")])
    return added.select("user_id", "event_type", "event_id")


@query(
    "a10_upsert",
    """SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer
       UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal FROM supplier""",
)
def upsert_customers(t):
    existing = t.customer.select("c_custkey", "c_name", "c_acctbal")
    cleared = existing.where("c_acctbal < 0").withColumn("c_acctbal", F.lit(None).cast("double"))
    new = t.supplier.select((F.lit(-1) - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name"), F.col("s_acctbal"))
    return upsert(existing, cleared.union(new), ["c_custkey"])


@query(
    "a12_old_name_view",
    "SELECT p_partkey AS part_number_id, p_name AS part_name, p_size AS part_size FROM part WHERE p_size > 10",
)
def old_name_view(t):
    names = {"p_partkey": "part_number_id", "p_name": "part_name", "p_size": "part_size"}
    register_views({"parts_file": t.part}, {"parts_file": names})
    return t.spark.sql("SELECT * FROM parts_file WHERE part_size > 10")


@query(
    "a13_many_farms",
    """SELECT c_mktsegment AS farm, count(*) AS row_count,
              sum(CASE WHEN c_mktsegment <> 'BUILDING' AND c_acctbal IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS with_balance
       FROM customer GROUP BY 1""",
)
def many_farms(t):
    customer = t.customer
    # a row for each farm
    names = [r[0] for r in customer.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]
    farms = {name: customer.where(F.col("c_mktsegment").eqNullSafe(name)).drop("c_mktsegment") for name in names}
    farms["BUILDING"] = farms["BUILDING"].drop("c_acctbal")
    united = unite_farms(farms)
    return united.groupBy("farm").agg(F.count(F.lit(1)).alias("row_count"), F.count("c_acctbal").alias("with_balance"))


@query(
    "a14_schema_union",
    """WITH f AS (
         SELECT 'customer' AS farm, 'custkey' AS column_name, 'bigint' AS type_name, count(c_custkey) AS filled FROM customer
         UNION ALL SELECT 'customer', 'name', 'string', count(c_name) FROM customer
         UNION ALL SELECT 'customer', 'nationkey', 'int', count(c_nationkey) FROM customer
         UNION ALL SELECT 'customer', 'acctbal', 'double', count(c_acctbal) FROM customer
         UNION ALL SELECT 'customer', 'mktsegment', 'string', count(c_mktsegment) FROM customer
         UNION ALL SELECT 'supplier', 'suppkey', 'bigint', count(s_suppkey) FROM supplier
         UNION ALL SELECT 'supplier', 'name', 'string', count(s_name) FROM supplier
         UNION ALL SELECT 'supplier', 'nationkey', 'int', count(s_nationkey) FROM supplier
         UNION ALL SELECT 'supplier', 'acctbal', 'double', count(s_acctbal) FROM supplier
         UNION ALL SELECT 'orders', 'orderkey', 'bigint', count(o_orderkey) FROM orders
         UNION ALL SELECT 'orders', 'custkey', 'bigint', count(o_custkey) FROM orders
         UNION ALL SELECT 'orders', 'orderstatus', 'string', count(o_orderstatus) FROM orders
         UNION ALL SELECT 'orders', 'totalprice', 'double', count(o_totalprice) FROM orders
         UNION ALL SELECT 'orders', 'orderdate', 'timestamp', count(o_orderdate) FROM orders
         UNION ALL SELECT 'orders', 'orderpriority', 'string', count(o_orderpriority) FROM orders)
       SELECT column_name, count(DISTINCT farm) AS present_in,
              string_agg(DISTINCT type_name, ',' ORDER BY type_name) AS types_seen, sum(filled)::BIGINT AS filled_rows
       FROM f GROUP BY column_name""",
)
def schema_union(t):
    """Columns over three tables: where present, with which types, how many rows filled."""
    parts = []
    for name in ("customer", "supplier", "orders"):
        df = getattr(t, name)
        types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString().replace("_ntz", ""))])
        filled = null_rates(df).select(
            F.lit(name).alias("farm"),
            F.regexp_replace("column_name", "^[a-z]+_", "").alias("column_name"),
            types[F.col("column_name")].alias("type_name"),
            (F.col("row_count") - F.col("null_count")).alias("filled"),
        )
        parts.append(filled)
    return (
        parts[0].union(parts[1]).union(parts[2])
        .groupBy("column_name")
        .agg(
            F.countDistinct("farm").alias("present_in"),
            F.array_join(F.array_sort(F.collect_set("type_name")), ",").alias("types_seen"),
            F.sum("filled").alias("filled_rows"),
        )
    )


@query(
    "a13_mixed_types",
    """SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'typed' ELSE 'text' END AS farm, o_orderkey,
              date_trunc('day', o_orderdate)::TIMESTAMP AS o_orderdate, o_totalprice
       FROM orders""",
)
def mixed_types(t):
    """Half of the orders with dates and prices as text, half typed, as two farms have them."""
    orders = t.orders.select("o_orderkey", F.date_trunc("day", "o_orderdate").alias("o_orderdate"), "o_totalprice")
    text = orders.where("o_orderkey % 2 <> 0").select(
        "o_orderkey", F.date_format("o_orderdate", "d/M/yyyy").alias("o_orderdate"), F.col("o_totalprice").cast("string").alias("o_totalprice")
    )
    return unite_farms({"typed": orders.where("o_orderkey % 2 = 0"), "text": text}).select(
        "farm", "o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"), "o_totalprice"
    )


@query(
    "a13_text_kept",
    """SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'numbers' ELSE 'codes' END AS farm, o_orderkey,
              CASE WHEN o_orderkey % 2 = 1 AND o_custkey % 5 = 0 THEN 'C-' ELSE '' END || CAST(o_custkey AS VARCHAR) AS code,
              CASE WHEN o_orderkey % 2 = 1 THEN '0' ELSE '' END || CAST(o_custkey AS VARCHAR) AS declared_text,
              CASE WHEN o_orderkey % 2 = 1 AND o_custkey % 5 = 0 THEN NULL ELSE o_totalprice END AS declared_number,
              o_totalprice AS price
       FROM orders""",
)
def text_kept(t):
    """One farm keeps numbers where another keeps text. Codes beside numbers stay, as no kind is declared and reading them
    as numbers would lose some; declared columns are what they are declared to be; prices are numbers on both."""
    odd = F.col("o_custkey") % 5 == 0
    numbers = t.orders.where("o_orderkey % 2 = 0").select(
        "o_orderkey",
        F.col("o_custkey").alias("Code"),
        F.col("o_custkey").alias("Declared_Text"),
        F.col("o_totalprice").alias("Declared_Number"),
        F.col("o_totalprice").alias("Price"),
    )
    codes = t.orders.where("o_orderkey % 2 = 1").select(
        "o_orderkey",
        F.concat(F.when(odd, "C-").otherwise(""), F.col("o_custkey")).alias("Code"),
        F.concat(F.lit("0"), F.col("o_custkey")).alias("Declared_Text"),
        F.when(odd, "not known").otherwise(F.col("o_totalprice").cast("string")).alias("Declared_Number"),
        F.col("o_totalprice").cast("string").alias("Price"),
    )
    spec = TableSpec("orders", "core.orders")
    declared = T.StructType.fromDDL("declared_text string, declared_number double")
    united = unite_farms({"numbers": numbers, "codes": codes}, lambda column: source_kind(spec, declared, column))
    return plan(spec, united, declared=declared).good


@query(
    "a9_two_keys",
    """WITH RECURSIVE e AS (SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events),
            k AS (SELECT *, CASE WHEN event_type <> 'view' THEN n // 2 END AS a, CASE WHEN value < 80 THEN (n + 1) // 2 END AS b FROM e),
            s AS (SELECT user_id, n, event_id, a, b, TRUE AS ok FROM k WHERE n = 0
                  UNION ALL SELECT k.user_id, k.n, k.event_id, k.a, k.b, NOT (s.ok AND coalesce(k.a = s.a OR k.b = s.b, FALSE))
                  FROM s JOIN k ON k.user_id = s.user_id AND k.n = s.n + 1)
       SELECT user_id, n, event_id FROM s WHERE ok""",
)
def insert_under_two_keys(t):
    """Rows under two unique keys that tie each row to the one before and the one after it, with missing keys between."""
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    rows = t.events.select("user_id", "event_id", "event_type", "value", place.cast("long").alias("n"))
    keyed = rows.select(
        "user_id", "n", "event_id",
        F.when(F.col("event_type") != "view", F.floor(F.col("n") / 2)).alias("a"),
        F.when(F.col("value") < 80, F.floor((F.col("n") + 1) / 2)).alias("b"),
    )
    return insert_ignoring(keyed, None, [("user_id", "a"), ("user_id", "b")], [F.col("n"), F.col("event_id")]).drop("a", "b")


class _Legacy:
    """Customers and orders as the tables of a legacy database, which has no third table."""

    def __init__(self, t):
        self.tables = {"Customers": t.customer, "Orders": t.orders}

    def read(self, table, group="main", farm=None):
        return self.tables.get(table)


LOADED = (
    TableSpec("Customers", "core.customers", order=10, validate="c_acctbal >= 0"),
    TableSpec("Suppliers", "core.suppliers", order=10),
    TableSpec("Orders", "core.orders", order=20, references=(Reference("o_custkey", "core.customers", "c_custkey", required=True),)),
)
LOG = """WITH good AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    SELECT 'Customers' AS source_table, 'core.customers' AS target_table, 'completed' AS status, count(*) AS rows_read,
           count(*) FILTER (WHERE c_acctbal >= 0) AS rows_written, count(*) FILTER (WHERE c_acctbal < 0) AS rows_validate,
           0::BIGINT AS rows_orphan, {kept} AS kept FROM customer
    UNION ALL SELECT 'Suppliers', 'core.suppliers', 'absent', NULL, NULL, NULL, NULL, 0::BIGINT
    UNION ALL SELECT 'Orders', 'core.orders', 'completed', count(*), count(*) FILTER (WHERE o_custkey IN (FROM good)), 0,
           count(*) FILTER (WHERE o_custkey NOT IN (FROM good)), {kept_orders} FROM orders"""


def _load(t, dry_run):
    """The log of a load into a store of its own, with the rows each target holds afterwards."""
    store = TargetStore(t.spark, f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/store-{uuid.uuid4().hex}")
    log = run(t.spark, LOADED, _Legacy(t), store, dry_run=dry_run)
    held = [(s.target, df) for s in LOADED if (df := store.read(s.target)) is not None]
    counts = [df.agg(F.lit(name).alias("target_table"), F.count(F.lit(1)).alias("kept")) for name, df in held]
    kept = reduce(DataFrame.union, counts) if counts else t.spark.createDataFrame([], "target_table string, kept long")
    numbers = ("rows_read", "rows_written", "rows_validate", "rows_orphan")
    return log.select("source_table", "target_table", "status", *numbers).join(kept, "target_table", "left").fillna(0, ["kept"])


@query("a11_run_log", LOG.format(kept="count(*) FILTER (WHERE c_acctbal >= 0)", kept_orders="count(*) FILTER (WHERE o_custkey IN (FROM good))"))
def run_log(t):
    return _load(t, False)


@query("a7_dry_run", LOG.format(kept="0::BIGINT", kept_orders="0::BIGINT"))
def dry_run(t):
    """The same counts, and nothing kept."""
    return _load(t, True)
