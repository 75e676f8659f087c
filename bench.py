"""Time the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.queries import QUERIES  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = (
    "a1_table_scan",
    "a4_raw_capture",
    "a9_insert_ignoring",
    "a10_upsert",
    "b1_column_mapping",
    "b3_row_derivation",
    "c3_rejection_counts",
    "c3_rejection_samples",
    "d1_surrogate_join",
    "d1_orphan_counts",
    "d6_null_unknown",
    "d8_orphans",
    "d10_converge_keys",
    "e2_null_rates",
    "e4_duplicate_keys",
    "e7_headers",
    "e8_cached_counts",
    "e11_duplicate_cost_groups",
    "f1_latest_row",
    "f2_unique_names",
    "f4_ranked_assignments",
    "f7_surrogate_ids",
    "i2_trim_or_null",
    "i4_to_timestamp",
    "i5_to_num",
    "j2_unpivot_measures",
    "j3_steps",
    "j4_mirror_moves",
    "k1_profile",
    "k2_fk_audit",
    "k5_load_checks",
    "k10_table_diff",
    "l2_users",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            # the test tables are small files: split them over all threads
            "spark.sql.files.openCostInBytes": "262144",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
