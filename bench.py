"""Time the headline queries: one JSON line on stdout.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2: the best of two runs counts), BENCH_QUERIES (names, comma separated).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from facetmill.catalog import QUERIES  # noqa: E402
from facetmill.session import build_session  # noqa: E402

HEADLINES = [
    "price_parse", "stg_sales_order_detail", "summed_lines", "stg_user_email", "email_change_intervals",
    "forward_fill", "dim_customer_scd", "dim_customer_current", "scd_point_in_time", "fx_densify_ffill",
    "fx_convert_lines", "sales_monthly_usd", "dim_store", "dim_product", "ip_range_lookup", "spread_lookup",
    "upsert_changed_only", "upsert_partial_columns", "late_merge", "product_id_list", "html_payload_status",
    "normalize_cart", "dq_report", "stream_dedup", "fact_sales", "mart_sales",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names.split(",") if names else HEADLINES:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name} {best:.2f}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus), "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
