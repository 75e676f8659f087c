"""Compare queries with their SQL: `python -m tests.oracle [folder] [name ...]`."""

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, bool):
        return f"bool:{value}"
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    if isinstance(value, float):
        return f"float:{value!r}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None when equal, else what differs."""
    result = con.execute(sql)
    expected = canonical([d[0] for d in result.description], result.fetchall())
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if expected[0] != got[0]:
        return f"columns {got[0]} != {expected[0]}"
    if len(expected[1]) != len(got[1]):
        return f"rows {len(got[1])} != {len(expected[1])}"
    for a, b in zip(got[1], expected[1]):
        if a != b:
            return f"{a} != {b}"
    return None


def main():
    sys.path.insert(0, os.getcwd())
    from __spark_entry__ import oracle_sql, queries
    from millrace.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    if os.environ.get("NO_BROADCAST"):
        # every lookup takes the way large ones take
        settings["spark.sql.autoBroadcastJoinThreshold"] = "-1"
    spark = build_session("oracle", "local[8]", **settings)
    spark.sparkContext.setLogLevel("OFF")
    con, sql, bad = connect(folder), oracle_sql(), 0
    for name, build in queries().items():
        if len(sys.argv) > 2 and not any(name.startswith(n) for n in sys.argv[2:]):
            continue
        start = time.time()
        try:
            problem = compare(build(spark, folder), con, sql[name]) if name in sql else "no sql"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__} {str(error)[:400]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if problem is None else 'DIFFERS ' + problem[:600]}", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
