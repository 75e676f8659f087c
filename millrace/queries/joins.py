"""D and H: references, orphans, missing parents, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import resolve
from millrace.operators.joins import left_lookup
from millrace.operators.merge import consolidate
from millrace.operators.rank import assign_ids
from millrace.plans.reports import diff
from millrace.plans.table_plan import outcome, plan
from millrace.queries.registry import query
from millrace.spec import Reference, TableSpec

KNOWN_ORDERS = "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS id FROM orders WHERE o_orderstatus <> 'P')"


def _surrogates(t):
    kept = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey")
    return assign_ids(kept, None, ["o_orderkey"], "id")


def _lines(t):
    spec = TableSpec(
        "lineitem",
        "core.lines",
        order=40,
        drop=tuple(c for c in t.lineitem.columns if c not in ("l_orderkey", "l_linenumber", "l_quantity")),
        mirror={"l_orderkey": ("legacy_orderkey",)},
        references=(Reference("l_orderkey", "orders", "o_orderkey", "id", required=True, also="order_id"),),
    )
    return plan(spec, t.lineitem, reader={"orders": _surrogates(t)}.get)


@query(
    "d1_surrogate_join",
    f"""SELECT k.id AS l_orderkey, l_orderkey AS legacy_orderkey, l_linenumber, l_quantity, k.id AS order_id
        FROM lineitem JOIN {KNOWN_ORDERS} k ON o_orderkey = l_orderkey""",
)
def surrogate_join(t):
    return _lines(t).good


@query(
    "d1_orphan_counts",
    f"""SELECT count(k.id) AS rows_written, count(*) FILTER (WHERE k.id IS NULL) AS rows_orphan
        FROM lineitem LEFT JOIN {KNOWN_ORDERS} k ON o_orderkey = l_orderkey""",
)
def orphan_counts(t):
    return outcome(_lines(t).frame).select("rows_written", "rows_orphan")


@query(
    "d1_missing_parent",
    "SELECT 0::BIGINT AS rows_written, count(*) AS rows_orphan, 0::BIGINT AS legacy_ids FROM lineitem",
)
def missing_parent(t):
    """The parent was never loaded: every line that names one is an orphan, and none keeps its legacy id."""
    spec = TableSpec(
        "lineitem", "core.lines", references=(Reference("l_orderkey", "orders", "o_orderkey", "id", required=True, also="order_id"),)
    )
    planned = plan(spec, t.lineitem)
    counted = outcome(planned.frame).select("rows_written", "rows_orphan")
    kept = planned.good.agg(F.count("l_orderkey").alias("legacy_ids"))
    # two frames of one row each
    return counted.withColumn("one", F.lit(1)).join(kept.withColumn("one", F.lit(1)), "one").drop("one")


@query(
    "d2_id_remap",
    """SELECT s_suppkey, CASE WHEN r_name <> 'ASIA' THEN 100 + n_nationkey END AS nation_id FROM supplier
       LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def id_remap(t):
    kept = t.region.where("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey"))
    nations = t.nation.join(kept, "n_regionkey", "left_semi")
    mapping = resolve.lookup(nations, "n_nationkey", F.col("n_nationkey") + 100)
    return resolve.remap(t.supplier, "s_nationkey", mapping, "nation_id").select("s_suppkey", "nation_id")


@query(
    "d3_name_lookup",
    """SELECT c_custkey, n_nationkey AS nation_id FROM customer
       LEFT JOIN nation ON upper(trim(n_name)) = upper(trim('  nation_' || c_nationkey || ' '))""",
)
def name_lookup(t):
    named = t.customer.withColumn("place", F.concat(F.lit("  nation_"), F.col("c_nationkey").cast("string"), F.lit(" ")))
    return resolve.remap_by_name(named, "place", t.nation, "n_name", "n_nationkey", "nation_id").select("c_custkey", "nation_id")


@query(
    "d4_chained_lookup",
    """SELECT c_custkey, r_regionkey AS region_id FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def chained_lookup(t):
    labels = left_lookup(t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, ["r_regionkey"])
    labels = labels.select("n_nationkey", F.concat(F.lit(" "), F.lower("r_name"), F.lit(" ")).alias("label"))
    mapping = resolve.chain(labels, "n_nationkey", "label", t.region, "r_name", "r_regionkey")
    return resolve.remap(t.customer, "c_nationkey", mapping, "region_id").select("c_custkey", "region_id")


@query(
    "d5_key_lookup",
    """SELECT o_orderkey, c_name AS customer FROM orders
       LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0""",
)
def key_lookup(t):
    mapping = resolve.lookup(t.customer.where("c_acctbal > 0"), "c_custkey", "c_name")
    return resolve.remap(t.orders, "o_custkey", mapping, "customer").select("o_orderkey", "customer")


@query(
    "d6_null_unknown",
    """SELECT l_orderkey, l_linenumber, s_suppkey AS l_suppkey, p_partkey AS l_partkey FROM lineitem
       LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 2000
       LEFT JOIN part ON p_partkey = l_partkey AND p_size <= 40""",
)
def null_unknown(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    lines = resolve.null_unknown(lines, ["l_suppkey"], t.supplier.where("s_acctbal > 2000"), "s_suppkey")
    return resolve.null_unknown(lines, ["l_partkey"], t.part.where("p_size <= 40"), "p_partkey")


@query(
    "d7_missing_parents",
    """WITH have AS (SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000),
            absent AS (SELECT DISTINCT 'Place ' || l_suppkey AS name FROM lineitem
                       WHERE l_suppkey NOT IN (SELECT s_suppkey FROM have))
       SELECT name, row_number() OVER (ORDER BY name) + (SELECT max(s_suppkey) FROM have) AS id FROM absent""",
)
def missing_parents(t):
    parents = t.supplier.where("s_acctbal > 2000").select(
        F.concat(F.lit("PLACE "), F.col("s_suppkey").cast("string")).alias("name"), F.col("s_suppkey").alias("id")
    )
    name = F.concat(F.lit("Place "), F.col("l_suppkey").cast("string"))
    return resolve.missing_parents(t.lineitem, name, parents, "name", "id")


@query(
    "d8_orphans",
    """SELECT l_returnflag, count(*) AS orphans FROM lineitem
       WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 40) GROUP BY 1""",
)
def orphans(t):
    lost = resolve.orphans(t.lineitem, "l_partkey", t.part.where("p_size <= 40"), "p_partkey")
    return lost.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("orphans"))


@query(
    "d9_fill_nulls",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN top ELSE c_acctbal END AS c_acctbal FROM customer
       LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def fill_nulls(t):
    target = t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))
    updates = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return resolve.fill_nulls(target, updates, "c_custkey", ["c_acctbal"])


@query(
    "d10_converge_keys",
    """WITH p AS (SELECT s_suppkey AS legacy, s_suppkey + (SELECT max(s_suppkey) // 2 FROM supplier) AS id
                  FROM supplier WHERE s_acctbal > 0)
       SELECT l_orderkey, l_linenumber,
              CASE WHEN v.id IS NOT NULL THEN l_suppkey WHEN m.id IS NOT NULL THEN m.id END AS supplier_id
       FROM lineitem LEFT JOIN p v ON v.id = l_suppkey LEFT JOIN p m ON m.legacy = l_suppkey""",
)
def converge_keys(t):
    shift = t.supplier.agg(F.floor(F.max("s_suppkey") / 2).alias("shift")).first()[0]
    parents = t.supplier.where("s_acctbal > 0").select((F.col("s_suppkey") + shift).alias("id"), F.col("s_suppkey").alias("legacy"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("supplier_id"))
    return resolve.converge_keys(lines, "supplier_id", parents, "id", "legacy")


@query(
    "d11_with_children",
    """SELECT c_custkey, TRUE AS has_orders FROM customer
         WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)
       UNION ALL SELECT c_custkey, FALSE FROM customer
         WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def with_children(t):
    large = t.orders.where("o_totalprice > 400000")
    have = resolve.having(t.customer, "c_custkey", large, "o_custkey").select("c_custkey", F.lit(True).alias("has_orders"))
    lack = resolve.having(t.customer, "c_custkey", large, "o_custkey", present=False)
    return have.union(lack.select("c_custkey", F.lit(False)))


@query(
    "d12_unresolved_sample",
    """SELECT DISTINCT c_nationkey FROM customer WHERE NOT EXISTS (
         SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal > 4000) ORDER BY 1 LIMIT 10""",
)
def unresolved_sample(t):
    return resolve.unresolved_sample(t.customer, "c_nationkey", t.supplier.where("s_acctbal > 4000"), "s_nationkey", 10)


@query(
    "h1_consolidate",
    """SELECT 'nation' AS category, n_nationkey AS code, n_name AS label, n_regionkey AS parent FROM nation
       UNION ALL SELECT 'region', r_regionkey, r_name, NULL FROM region
       UNION ALL SELECT 'segment', c_custkey, c_mktsegment, c_nationkey FROM customer""",
)
def consolidate_lookups(t):
    nation = t.nation.select(
        F.col("n_nationkey").cast("long").alias("code"), F.col("n_name").alias("label"), F.col("n_regionkey").alias("parent")
    )
    region = t.region.select(F.col("r_regionkey").cast("long").alias("code"), F.col("r_name").alias("label"))
    segment = t.customer.select(
        F.col("c_custkey").alias("code"), F.col("c_mktsegment").alias("label"), F.col("c_nationkey").alias("parent")
    )
    return consolidate({"nation": nation, "region": region, "segment": segment}, "category")


@query(
    "h2_key_differences",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, 'missing' AS kind FROM orders WHERE o_orderstatus = 'P'
       UNION ALL SELECT CAST(-1 - c_custkey AS VARCHAR), 'extra' FROM customer WHERE c_acctbal < 0""",
)
def key_differences(t):
    copy = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey")
    added = t.customer.where("c_acctbal < 0").select((F.lit(-1) - F.col("c_custkey")).alias("o_orderkey"))
    return diff(t.orders, copy.union(added), "o_orderkey", "o_orderkey", {}).select("key", "kind")


@query("h3_distinct", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct(t):
    return t.customer.select("c_mktsegment", "c_nationkey").distinct()
