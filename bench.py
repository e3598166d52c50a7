"""Time the headline queries (or those named on the command line, or ``all``) and print one JSON line.

    BENCH_SF_DIR   data to read    (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores     (default 8)
    BENCH_RUNS     runs per query  (default 2; the best one counts)

Every query is executed in full into Spark's no-op sink, so nothing is pulled to
the driver and nothing is skipped by a count.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


HEADLINE = [
    "stg_event_params", "stg_items", "stg_event_param_pivot",
    "int_sessions", "int_purchase_items", "int_users",
    "agg_daily_sessions", "agg_daily_geo", "agg_daily_product_revenue", "agg_weekly_dropoff_rates",
    "fct_events", "fct_purchases", "fct_daily_web_metrics", "dim_funnel_daily", "dim_product_daily",
    "rpt_funnel_sessions", "rpt_sessions_wide", "rpt_product_sales", "filter_loss_audit",
    "commerce_silver", "customer_ltv", "hourly_category_revenue",
    "station_curated", "station_incremental",
    "trips_silver", "trips_quarantine", "city_daily_kpis", "zone_daily_kpis",
    "dq_order_arithmetic", "bronze_stream_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session(
        "tidemark-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    for name, build in QUERIES.items():
        if name not in chosen and "all" not in chosen:
            continue
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - start
            best = elapsed if best is None else min(best, elapsed)
        timings[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
