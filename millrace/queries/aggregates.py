"""E: counts, null rates, ranges, duplicates, headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import history, quality
from millrace.operators.joins import left_lookup
from millrace.queries.registry import query



@query(
    "e1_counts",
    """SELECT count(*) AS row_count, count(DISTINCT o_custkey) AS distinct_o_custkey,
              count(DISTINCT o_orderpriority) AS distinct_o_orderpriority FROM orders""",
)
def counts(t):
    return quality.count_rows(t.orders, ["o_custkey", "o_orderpriority"])


@query(
    "e2_null_rates",
    """WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
                         CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer),
            n AS (SELECT count(*) AS a, count(c_custkey) AS k, count(c_acctbal) AS b, count(c_mktsegment) AS m FROM c)
       SELECT 'c_custkey' AS column_name, a - k AS null_count, a AS row_count, round((a - k) * 100.0 / a, 1)::DOUBLE AS null_pct FROM n
       UNION ALL SELECT 'c_acctbal', a - b, a, round((a - b) * 100.0 / a, 1)::DOUBLE FROM n
       UNION ALL SELECT 'c_mktsegment', a - m, a, round((a - m) * 100.0 / a, 1)::DOUBLE FROM n""",
)
def null_rates(t):
    holes = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    return quality.null_rates(holes).withColumn("null_pct", F.col("null_pct").cast("double"))


@query(
    "e3_date_ranges",
    """SELECT 'o_orderdate' AS column_name, min(o_orderdate) AS min_date, max(o_orderdate) AS max_date FROM orders
       UNION ALL SELECT 'l_shipdate', min(l_shipdate), max(l_shipdate) FROM lineitem
       UNION ALL SELECT 'ts', min(ts), max(ts) FROM events""",
)
def date_ranges(t):
    parts = [quality.date_ranges(df, [c]) for df, c in ((t.orders, "o_orderdate"), (t.lineitem, "l_shipdate"), (t.events, "ts"))]
    return parts[0].union(parts[1]).union(parts[2])


@query(
    "e4_duplicate_keys",
    """SELECT count(*) AS duplicate_groups, coalesce(sum(n - 1), 0)::BIGINT AS excess_rows
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)""",
)
def duplicate_keys(t):
    return quality.duplicate_summary(quality.duplicate_groups(t.lineitem, ["l_orderkey"]))


@query(
    "e5_composite_duplicates",
    """SELECT user_id, replace(upper(event_type || ' '), ' ', '') AS kind, count(*) AS row_count FROM events
       WHERE value > 10 AND user_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""",
)
def composite_duplicates(t):
    kind = F.replace(F.upper(F.concat("event_type", F.lit(" "))), F.lit(" "), F.lit("")).alias("kind")
    return quality.duplicate_groups(t.events, ["user_id", kind], F.col("value") > 10)


@query(
    "e6_filtered_counts",
    """SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) FILTER (WHERE o_orderstatus = 'O') AS open,
              count(*) FILTER (WHERE o_orderstatus = 'P') AS pending, max(o_orderdate) AS last_order FROM orders""",
)
def filtered_counts(t):
    tests = {name: F.col("o_orderstatus") == code for name, code in (("finished", "F"), ("open", "O"), ("pending", "P"))}
    return quality.filtered_counts(t.orders, tests, last_order=F.max("o_orderdate"))


@query(
    "e7_headers",
    """SELECT l_orderkey, max(l_linenumber) AS lines, bool_or(l_returnflag = 'R') AS any_returned FROM lineitem GROUP BY 1""",
)
def headers(t):
    return t.lineitem.groupBy("l_orderkey").agg(
        F.max("l_linenumber").alias("lines"), F.bool_or(F.col("l_returnflag") == "R").alias("any_returned")
    )


@query(
    "e8_cached_counts",
    """SELECT c_custkey, coalesce(n, 0) AS open_orders FROM customer LEFT JOIN (
         SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) ON o_custkey = c_custkey""",
)
def cached_counts(t):
    return history.cached_counts(
        t.customer.select("c_custkey"), "c_custkey", t.orders, "o_custkey", F.col("o_orderstatus") == "O", "open_orders"
    )


@query(
    "e9_fill_ratio",
    """SELECT count(*) AS kept_rows, count(quality) AS filled_rows, count(DISTINCT quality) AS distinct_values,
              round(count(quality) / count(*), 4) AS fill_ratio, count(*) = 0 OR count(quality) > 0 AS passed
       FROM documents LEFT JOIN labels USING (doc_id) WHERE lang = 'en'""",
)
def fill_ratio(t):
    labels = t.labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    joined = left_lookup(t.documents.select("doc_id", "lang"), labels, ["doc_id"])
    return quality.fill_ratio(joined, F.col("lang") == "en", F.col("quality"))


@query(
    "e10_stranded_columns",
    """SELECT 'size' AS old_column, 'size_mm' AS new_column, count(p_size) AS old_filled, 0::BIGINT AS new_filled,
              count(p_size) > 0 AS stranded FROM part
       UNION ALL SELECT 'price', 'retail_price', count(p_retailprice), count(p_retailprice), FALSE FROM part""",
)
def stranded_columns(t):
    parts = t.part.select(
        F.col("p_size").alias("size"),
        F.lit(None).cast("int").alias("size_mm"),
        F.col("p_retailprice").alias("price"),
        F.col("p_retailprice").alias("retail_price"),
    )
    return quality.stranded_columns(parts, [("size", "size_mm"), ("price", "retail_price"), ("gone", "also_gone")])


@query(
    "e11_duplicate_cost_groups",
    """SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS row_count,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
       FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def duplicate_cost_groups(t):
    exact = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    return quality.duplicate_groups(t.lineitem, ["l_suppkey", "l_returnflag", "l_linestatus"], total=exact)
