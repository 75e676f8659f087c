"""B and C: column mapping, rules and quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.kinds import KINDS
from millrace.functions.names import json_cell
from millrace.operators.shape import fill_both_ways
from millrace.plans.table_plan import outcome, plan, rejected_counts, rejected_samples
from millrace.queries.registry import query
from millrace.sources import declared_schemas
from millrace.spec import Reference, Rule, TableSpec


@query(
    "b1_column_mapping",
    """SELECT s_suppkey AS supplier_id, s_name AS name, upper(trim(s_name)) AS label, s_nationkey, s_acctbal AS balance,
              s_acctbal AS acct FROM supplier""",
)
def column_mapping(t):
    spec = TableSpec(
        "supplier",
        "core.suppliers",
        rename={"s_suppkey": "supplier_id", "s_name": "name", "s_acctbal": "balance"},
        mirror={"s_acctbal": ("acct",)},
        derive={"label": lambda df: F.upper(F.trim("s_name"))},
    )
    return plan(spec, t.supplier).good


@query(
    "b1_text_typed",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_quantity AS moved_qty,
              l_extendedprice AS line_price, date_trunc('day', l_shipdate)::TIMESTAMP AS ship_date FROM lineitem""",
)
def text_typed(t):
    """Numbers and dates that a source keeps as text come out as what the target declares."""
    text = t.lineitem.select(
        F.col("l_orderkey").alias("Order_ID"),
        F.col("l_linenumber").alias("Line_Number"),
        F.col("l_quantity").cast("string").alias("Moved_Qty"),
        F.col("l_extendedprice").cast("string").alias("Line_price"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("Ship_date"),
    )
    declared = T.StructType.fromDDL("moved_qty double, line_price double, ship_date timestamp")
    good = plan(TableSpec("lines", "core.lines"), text, declared=declared).good
    return good.withColumn("ship_date", F.col("ship_date").cast("timestamp_ntz"))


#: What a target database lists in information_schema.columns, here for the table of b1_declared_kinds.
LISTED = (
    ("order_id", "bigint", "NO"),
    ("head_todate", "numeric", "YES"),
    ("date_format", "character varying", "YES"),
    ("pay_weight", "boolean", "YES"),
    ("ship_date", "date", "YES"),
    ("ship_time", "time without time zone", "YES"),
    ("old_code", "text", "YES"),
    ("line", "integer", "YES"),
)


@query(
    "b1_declared_kinds",
    """SELECT l_orderkey AS order_id, l_quantity AS head_todate, l_shipmode AS date_format, l_linestatus = 'O' AS pay_weight,
              CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS ship_date,
              lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':30:00' AS ship_time,
              CASE WHEN l_linenumber = 1 THEN 'A-' ELSE '0' END || CAST(l_suppkey AS VARCHAR) AS old_code,
              CASE WHEN l_linenumber < 5 THEN l_linenumber::INTEGER END AS line
       FROM (SELECT *, CASE l_linestatus WHEN 'O' THEN 'AIR' ELSE 'TRUCK' END AS l_shipmode FROM lineitem)
       WHERE l_linenumber <> 7""",
)
def declared_kinds(t):
    """A table kept wholly as text, read as its target declares it, whatever its columns are called: a number named like a
    date, a text named like a date, a flag named like a number; a row without what the target needs is set aside."""
    n = F.col("l_linenumber")
    text = t.lineitem.select(
        F.when(n != 7, F.concat(F.lit(" "), F.col("l_orderkey"))).alias("Order_ID"),
        F.col("l_quantity").cast("string").alias("Head_ToDate"),
        F.when(F.col("l_linestatus") == "O", "AIR ").otherwise(" TRUCK").alias("Date_format"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("Pay_Weight"),
        F.when(F.col("l_returnflag") == "N", "31/02/1998").otherwise(F.date_format("l_shipdate", "d/M/yyyy")).alias("Ship_Date"),
        F.concat(n.cast("string"), F.lit(".30")).alias("Ship_Time"),
        F.concat(F.when(n == 1, "A-").otherwise("0"), F.col("l_suppkey")).alias("Old_Code"),
        F.when(n < 5, n.cast("string")).otherwise("none").alias("Line"),
    )
    listed = t.spark.createDataFrame([("core", "lines", *c) for c in LISTED], "table_schema string, table_name string, column_name string, data_type string, is_nullable string")
    return plan(TableSpec("lines", "core.lines"), text, declared=declared_schemas(listed)["core.lines"]).good


@query(
    "b2_static_columns",
    "SELECT 'brand' AS category, p_partkey AS code, p_brand AS label FROM part",
)
def static_columns(t):
    spec = TableSpec(
        "part",
        "core.lookups",
        rename={"p_partkey": "code", "p_brand": "label"},
        drop=("p_name", "p_type", "p_size", "p_retailprice"),
        static={"category": "brand"},
    )
    return plan(spec, t.part).good


@query(
    "b3_row_derivation",
    """SELECT l_orderkey, l_linenumber, 
              CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2))) AS DOUBLE) AS net_price,
              CASE WHEN l_returnflag = 'R' THEN 'returned' WHEN l_linestatus = 'O' THEN 'open' ELSE 'done' END AS state
       FROM lineitem""",
)
def row_derivation(t):
    state = F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_linestatus") == "O", "open").otherwise("done")
    spec = TableSpec(
        "lineitem",
        "core.lines",
        drop=tuple(c for c in t.lineitem.columns if c not in ("l_orderkey", "l_linenumber")),
        derive={
            "net_price": lambda df: (
                F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
            ).cast("double"),
            "state": lambda df: state,
        },
    )
    return plan(spec, t.lineitem).good


@query(
    "b5_case_projection",
    """SELECT CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE 'none' END AS flag_name,
              count(*) AS row_count FROM lineitem GROUP BY 1""",
)
def case_projection(t):
    flag = F.when(F.col("l_returnflag") == "A", "accepted").when(F.col("l_returnflag") == "R", "returned").otherwise("none")
    return t.lineitem.select(flag.alias("flag_name")).groupBy("flag_name").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "b6_fill_both_ways",
    """SELECT o_orderkey, coalesce(a, b) AS old_price, coalesce(b, a) AS new_price FROM (
         SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS a,
                CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS b FROM orders)""",
)
def both_ways(t):
    halves = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("old_price"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("new_price"),
    )
    return fill_both_ways(halves, {"old_price": "new_price"})


@query(
    "c1_junk_rows",
    """SELECT lang, count(*) FILTER (WHERE length(trim(text)) < 400 OR text LIKE '%http%') AS rows_junk,
              count(*) FILTER (WHERE NOT (length(trim(text)) < 400 OR text LIKE '%http%')) AS rows_written
       FROM documents GROUP BY lang""",
)
def junk_rows(t):
    spec = TableSpec(
        "documents",
        "core.documents",
        drop=("text",),
        skip=lambda df: (F.length(F.trim("text")) < 400) | F.col("text").contains("http"),
    )
    frame = plan(spec, t.documents).frame
    return frame.groupBy("lang").agg(
        F.count_if(F.col("_reason") == "junk").alias("rows_junk"), F.count_if(F.col("_reason").isNull()).alias("rows_written")
    )


@query(
    "c2_row_validation",
    """SELECT count(*) FILTER (WHERE l_quantity > 5 AND l_discount < 0.09) AS rows_written,
              count(*) FILTER (WHERE NOT (l_quantity > 5 AND l_discount < 0.09)) AS rows_validate
       FROM lineitem""",
)
def row_validation(t):
    spec = TableSpec("lineitem", "core.lines", validate="l_quantity > 5 AND l_discount < 0.09")
    return outcome(plan(spec, t.lineitem).frame).select("rows_written", "rows_validate")


def _judged(t):
    """Line items against the orders that are not pending, with every kind of rejection."""
    open_orders = t.orders.where("o_orderstatus <> 'P'")
    spec = TableSpec(
        "lineitem",
        "core.lines",
        order=40,
        skip=lambda df: F.col("l_quantity") < 2,
        references=(Reference("l_orderkey", "orders", "o_orderkey", required=True),),
        validate="l_discount <= 0.08",
        rules=(
            Rule("tax", "l_tax < 0.08"),
            Rule("price", "l_extendedprice BETWEEN 1000 AND 90000"),
        ),
    )
    return plan(spec, t.lineitem, reader={"orders": open_orders}.get)


JUDGED = """WITH judged AS (
    SELECT l.*, CASE WHEN l_quantity < 2 THEN 'junk' WHEN o_orderkey IS NULL THEN 'orphan'
                     WHEN NOT l_discount <= 0.08 THEN 'validate' WHEN NOT l_tax < 0.08 THEN 'rule:tax'
                     WHEN NOT l_extendedprice BETWEEN 1000 AND 90000 THEN 'rule:price' END AS reason
    FROM lineitem l LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') o ON o_orderkey = l_orderkey)
"""


@query("c3_rejection_counts", JUDGED + "SELECT reason, count(*) AS row_count FROM judged WHERE reason IS NOT NULL GROUP BY 1")
def rejection_counts(t):
    return rejected_counts(_judged(t).frame)


@query(
    "c3_rejection_samples",
    JUDGED
    + """SELECT reason, l_orderkey, l_linenumber FROM (
           SELECT *, row_number() OVER (PARTITION BY reason ORDER BY l_orderkey, l_linenumber) AS n
           FROM judged WHERE reason IS NOT NULL) WHERE n <= 25""",
)
def rejection_samples(t):
    keys = [json_cell("row_data", c).cast("long").alias(c) for c in ("l_orderkey", "l_linenumber")]
    rejected = _judged(t).rejected.select("reason", "row_data", *keys)
    samples = rejected_samples(rejected, ["reason"], 25, [F.col("l_orderkey"), F.col("l_linenumber")])
    return samples.select("reason", "l_orderkey", "l_linenumber")


@query(
    "c4_rules",
    """SELECT CASE WHEN NOT p_size BETWEEN 2 AND 45 THEN 'rule:size' WHEN NOT p_retailprice >= 950 THEN 'rule:price'
                   ELSE 'good' END AS outcome, count(*) AS row_count FROM part GROUP BY 1""",
)
def rules(t):
    spec = TableSpec(
        "part",
        "core.parts",
        rules=(
            Rule("size", "p_size BETWEEN 2 AND 45"),
            Rule("price", "p_retailprice >= 950"),
        ),
    )
    judged = plan(spec, t.part).frame.select(F.coalesce("_reason", F.lit("good")).alias("outcome"))
    return judged.groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "c5_source_filter",
    "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IS NOT NULL AND c_acctbal > 0",
)
def source_filter(t):
    spec = TableSpec(
        "customer",
        "core.customers",
        drop=("c_nationkey", "c_acctbal", "c_mktsegment"),
        where=lambda df: F.col("c_mktsegment").isNotNull() & (F.col("c_acctbal") > 0),
    )
    return plan(spec, t.customer).good


@query(
    "c7_sentinels",
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1900-01-01 00:00:00' ELSE o_orderdate END AS event_date,
              CASE WHEN o_custkey IN (0, 1) THEN NULL ELSE o_custkey - 1 END AS record_number,
              CASE WHEN o_totalprice - 100000 >= 0 THEN o_totalprice - 100000 END AS dose,
              CASE WHEN o_custkey <> 0 THEN o_custkey END AS fk
       FROM orders""",
)
def sentinels(t):
    df = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("d"),
        (F.col("o_custkey") - 1).alias("n"),
        (F.col("o_totalprice") - 100000).alias("p"),
        F.col("o_custkey").alias("k"),
    )

    def clean(kind, name):
        return KINDS[kind](F.col(name), df.schema[name].dataType)

    return df.select(
        "o_orderkey",
        clean("event_date", "d").alias("event_date"),
        clean("record_number", "n").alias("record_number"),
        clean("not_negative", "p").alias("dose"),
        clean("fk", "k").alias("fk"),
    )
