"""I: cleaning functions over whole tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import functions as fn
from millrace.functions.kinds import KINDS
from millrace.plans.reports import comparison_text
from millrace.queries.registry import query


def _by(column: str, texts: dict) -> Column:
    """A text per value of a column, to give the functions something to clean."""
    chain = None
    for value, text in texts.items():
        text = text if isinstance(text, Column) else F.lit(text)
        test = F.col(column) == value
        chain = F.when(test, text) if chain is None else chain.when(test, text)
    return chain


@query(
    "i1_to_bool",
    """SELECT event_id, coalesce(upper(CASE event_type WHEN 'view' THEN 'y' WHEN 'click' THEN 'TRUE' WHEN 'signup' THEN '1'
                                   WHEN 'purchase' THEN ' Y ' ELSE NULL END) IN ('1', 'Y', 'TRUE'), FALSE) AS flag,
              value > 50 AS large FROM events""",
)
def to_bool(t):
    text = _by("event_type", {"view": "y", "click": "TRUE", "signup": "1", "purchase": " Y "})
    return t.events.select("event_id", fn.to_bool(text).alias("flag"), fn.to_bool(F.col("value") > 50, T.BooleanType()).alias("large"))


BLANKS = r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


@query(
    "i2_trim_or_null",
    f"""SELECT doc_id, length(cleaned) AS n, md5(cleaned) AS digest FROM (
          SELECT doc_id, nullif(regexp_replace(CASE WHEN lang = 'de' THEN chr(9) || chr(160) ELSE chr(9) || text || chr(12288) END,
                                               '^{BLANKS}+|{BLANKS}+$', '', 'g'), '') AS cleaned FROM documents)""",
)
def trim_or_null(t):
    padded = F.concat(F.lit("\t"), "text", F.lit(chr(12288)))
    text = F.when(F.col("lang") == "de", F.lit("\t" + chr(160))).otherwise(padded)
    cleaned = fn.trim_or_null(text)
    return t.documents.select("doc_id", cleaned.alias("c")).select(
        "doc_id", F.length("c").alias("n"), F.md5(F.col("c").cast("binary")).alias("digest")
    )


@query(
    "i3_to_binary",
    """SELECT doc_id, CASE WHEN lang <> 'fr' AND octet_length(encode(text)) > 0 THEN octet_length(encode(text)) END AS bytes
       FROM documents""",
)
def to_binary(t):
    content = F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.col("text")).cast("binary")
    return t.documents.select("doc_id", F.octet_length(fn.to_binary(content, T.BinaryType())).cast("long").alias("bytes"))


@query(
    "i4_to_timestamp",
    """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate
              WHEN month(o_orderdate) IN (1, 3, 5, 7, 8, 10, 12)
                THEN make_timestamp(year(o_orderdate), month(o_orderdate), 31, 10, 30, 0) END AS stamp FROM orders""",
)
def to_timestamp(t):
    text = _by(
        "o_orderstatus",
        {
            "F": F.date_format("o_orderdate", "d/M/yyyy"),
            "O": F.date_format("o_orderdate", "yyyy-MM-dd"),
            "P": F.concat(F.lit("31/"), F.date_format("o_orderdate", "M/yyyy"), F.lit(" 10:30")),
        },
    )
    return t.orders.select("o_orderkey", fn.to_timestamp(text).alias("stamp"))


NUMBER_TEXT = {"click": "", "signup": "abc"}


@query(
    "i5_to_num",
    """SELECT event_id, CASE event_type WHEN 'view' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) WHEN 'click' THEN 0
                                        WHEN 'purchase' THEN value END AS number FROM events""",
)
def to_num(t):
    texts = {
        "view": F.get_json_object("props", "$.k"),
        "purchase": F.concat(F.lit(" "), F.col("value").cast("string"), F.lit("\t")),
        **NUMBER_TEXT,
    }
    return t.events.select("event_id", fn.to_num(_by("event_type", texts)).alias("number"))


@query(
    "i6_to_fk_id",
    """SELECT event_id, CASE event_type WHEN 'view' THEN nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) END AS fk
       FROM events""",
)
def to_fk_id(t):
    text = _by("event_type", {"view": F.get_json_object("props", "$.k"), **NUMBER_TEXT})
    return t.events.select("event_id", fn.to_fk_id(text).alias("fk"))


@query(
    "i7_to_time",
    """SELECT event_id, CASE event_type
         WHEN 'view' THEN strftime(ts, '%H:%M:00') WHEN 'click' THEN strftime(ts, '%H:%M:00')
         WHEN 'signup' THEN strftime(ts, '%H:%M:%S')
         WHEN 'purchase' THEN CASE WHEN hour(ts) + 10 <= 23 THEN (hour(ts) + 10) || ':00:00' END END AS clock FROM events""",
)
def to_time(t):
    texts = {
        "view": F.date_format("ts", "H.m"),
        "click": F.date_format("ts", "H;mm"),
        "signup": F.date_format("ts", " H : m : s "),
        "purchase": F.concat((F.hour("ts") + 10).cast("string"), F.lit(",0")),
        "error": "soon",
    }
    return t.events.select("event_id", fn.to_time(_by("event_type", texts)).alias("clock"))


@query(
    "i8_sex",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'steer' WHEN 'BUILDING' THEN 'bull' WHEN 'FURNITURE' THEN 'cow'
              WHEN 'MACHINERY' THEN 'steer' ELSE 'heifer' END AS sex FROM customer""",
)
def sex(t):
    code = _by("c_mktsegment", {"AUTOMOBILE": "s", "BUILDING": " B ", "FURNITURE": "C", "MACHINERY": "m"})
    return t.customer.select("c_custkey", fn.sex(code).alias("sex"))


@query(
    "i9_lifecycle_status",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'died'
              WHEN o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' THEN 'sold'
              WHEN o_orderstatus = 'F' THEN 'archived' ELSE 'active' END AS status FROM orders""",
)
def lifecycle_status(t):
    died = F.when(F.col("o_totalprice") > 400000, "Y").otherwise("N")
    sale = F.when(F.col("o_orderpriority") == "5-LOW", "1900-01-01").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    sold = F.when(F.col("o_orderstatus") == "O", sale)
    archived = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    types = (T.StringType(), T.StringType(), T.TimestampType())
    return t.orders.select("o_orderkey", fn.lifecycle_status(died, sold, archived, types).alias("status"))


@query(
    "i10_weigh_type",
    """SELECT CASE l_linenumber WHEN 1 THEN 'intake' WHEN 3 THEN 'exit' WHEN 4 THEN 'sale' ELSE 'interim' END AS weigh_type,
              count(*) AS row_count FROM lineitem GROUP BY 1""",
)
def weigh_type(t):
    kinds = t.lineitem.select(fn.weigh_type(F.col("l_linenumber"), T.IntegerType()).alias("weigh_type"))
    return kinds.groupBy("weigh_type").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "i11_cost_type",
    """SELECT l_returnflag, CASE WHEN l_returnflag IN ('A', 'R') THEN 'revenue' ELSE 'expense' END AS cost_type,
              count(*) AS row_count FROM lineitem GROUP BY 1, 2""",
)
def cost_type(t):
    mark = _by("l_returnflag", {"A": "+", "R": " r ", "N": "-"})
    kinds = t.lineitem.select("l_returnflag", fn.cost_type(mark).alias("cost_type"))
    return kinds.groupBy("l_returnflag", "cost_type").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "i12_contact_type",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'vendor' WHEN 'BUILDING' THEN 'vendor'
                WHEN 'FURNITURE' THEN 'customer-feeder' WHEN 'HOUSEHOLD' THEN 'agistor' ELSE 'other' END
              ELSE CASE c_nationkey WHEN 2 THEN 'agistor' WHEN 3 THEN 'vendor' WHEN 4 THEN 'carrier' WHEN 6 THEN 'buyer'
                WHEN 7 THEN 'abattoir' WHEN 8 THEN 'agent' WHEN 10 THEN 'buyer' WHEN 11 THEN 'customer-feeder' ELSE 'other' END
              END AS contact_type FROM customer""",
)
def contact_type(t):
    names = {"AUTOMOBILE": "Vendor Co", "BUILDING": "V", "FURNITURE": "custom feed", "HOUSEHOLD": "Agistment", "MACHINERY": "zzz"}
    text = F.when(F.col("c_acctbal") < 0, _by("c_mktsegment", names)).otherwise(F.col("c_nationkey").cast("string"))
    return t.customer.select("c_custkey", fn.contact_type(text).alias("contact_type"))


@query(
    "i13_flags_and_defaults",
    """SELECT l_linestatus <> 'O' AS active, CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE l_quantity END AS units,
              count(*) AS row_count FROM lineitem GROUP BY 1, 2""",
)
def flags_and_defaults(t):
    stopped = F.when(F.col("l_linestatus") == "O", "Y")
    units = F.when(F.col("l_returnflag") != "A", F.col("l_quantity"))
    cleaned = t.lineitem.select(
        KINDS["not_bool"](stopped, T.StringType()).alias("active"), KINDS["num_or_one"](units, T.DoubleType()).alias("units")
    )
    return cleaned.groupBy("active", "units").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "i14_fallback_key",
    """SELECT c_custkey, CASE WHEN c_acctbal < 2000 THEN 'LEGACY-' || c_custkey ELSE c_name END AS lot FROM customer""",
)
def fallback_key(t):
    name = F.when(F.col("c_acctbal") < 0, "  ").when(F.col("c_acctbal") >= 2000, F.col("c_name"))
    return t.customer.select("c_custkey", fn.fallback_key(name, "c_custkey").alias("lot"))


@query(
    "i15_names",
    "SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_name FROM part",
)
def names(t):
    pad = lambda c: F.concat(F.lit("  "), F.col(c), F.lit("\t"))
    return t.part.select(
        "p_partkey", fn.upper_name(pad("p_name")).alias("upper_name"), fn.lower_name(pad("p_type")).alias("lower_name")
    )


@query(
    "i16_slug",
    """WITH s AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size || ' ' || p_name ELSE ' ' || p_name || ' & ' || p_brand || '!' END AS n
                  FROM part),
            w AS (SELECT p_partkey, regexp_replace(regexp_replace(replace(lower(n), '&', '_and_'), '[^a-z0-9]+', '_', 'g'),
                                                   '_+', '_', 'g') AS n FROM s),
            b AS (SELECT p_partkey, regexp_replace(n, '^_+|_+$', '', 'g') AS n FROM w)
       SELECT p_partkey, CASE WHEN regexp_matches(n, '^[a-z_]') THEN n ELSE 'farm_' || n END AS slug FROM b""",
)
def slug(t):
    numbered = F.concat(F.col("p_size").cast("string"), F.lit(" "), "p_name")
    joined = F.concat(F.lit(" "), "p_name", F.lit(" & "), "p_brand", F.lit("!"))
    return t.part.select("p_partkey", fn.farm_slug(F.when(F.col("p_size") > 25, numbered).otherwise(joined)).alias("slug"))


PERSON = """SELECT c_custkey, CASE WHEN c_acctbal > 1000 THEN ' Mary Ann' END AS f,
                   CASE WHEN c_acctbal < 5000 THEN c_name END AS s, lower(c_mktsegment) AS farm FROM customer"""


@query(
    "i17_identity",
    f"""SELECT c_custkey,
               coalesce(nullif(concat_ws('.', replace(lower(trim(f)), ' ', ''), lower(s)), ''), 'user' || c_custkey)
                 || '+' || farm || '@legacy.invalid' AS email,
               coalesce(nullif(concat_ws('.', replace(lower(trim(f)), ' ', ''), replace(lower(s), '#', '')), ''), 'user' || c_custkey)
                 || '__' || farm AS username
        FROM ({PERSON})""",
)
def identity(t):
    first = F.when(F.col("c_acctbal") > 1000, F.lit(" Mary Ann"))
    last = F.when(F.col("c_acctbal") < 5000, F.col("c_name"))
    who = (first, last, F.col("c_custkey"), F.lower("c_mktsegment"))
    return t.customer.select(
        "c_custkey", fn.synthetic_email(*who).alias("email"), fn.synthetic_username(*who).alias("username")
    )


@query("i18_json_cell", "SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS absent FROM events")
def json_cell(t):
    return t.events.select("event_id", fn.json_cell("props", "k").alias("k"), fn.json_cell("props", "a b/c").alias("absent"))


@query(
    "i19_comparison_text",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
              CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END AS flag FROM lineitem""",
)
def comparison(t):
    flag = F.when(F.col("l_returnflag") != "A", F.concat(F.lit(" "), "l_returnflag")).alias("flag")
    df = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), flag)
    return df.select(
        "l_orderkey", "l_linenumber", *[comparison_text(df, c).alias(c) for c in ("quantity", "flag")]
    )
