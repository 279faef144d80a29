"""Time the warehouse build and the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the star-schema Parquet tables (default sf0.1)
BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from grainhouse.plans.warehouse import close_driver_warehouses, open_driver_warehouse
from grainhouse.registry import entries
from grainhouse.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "r_monthly_items", "r_monthly_net", "r_daily_net", "r_repeat_customers", "r_second_order_gap", "r_pareto",
    "r_category_top10", "r_approval_minutes", "r_distance_bucket", "r_route_type", "r_freight_pct", "r_weight_bucket",
    "r_instalments_bucket", "r_weekday", "r_holiday_test", "r_bucket_score", "r_city_state", "r_delay_severity", "r_cliff",
    "r_page_overview", "r_page_delivery", "r_page_payments", "r_page_promise", "r_page_promise_weeks",
    "m_revenue_kinds", "m_net_share", "m_delivered_late", "m_handling_share_top10", "m_points_lost", "m_payment_mix",
    "dq_payment_fanout", "dq_missing_keys", "dq_grain_dups", "dq_payment_item_gap", "dq_revenue_bridge",
    "h_scd2", "h_incremental",
    "dq_orphans", "dq_key_population", "dq_gates", "ctx_sliced_counts", "r_page_geography_seller", "win_rank_rows", "h_scd2_twice",
    "h_incremental_load", "rebuild_gates", "io_open_current",
]


def main() -> None:
    spark = local_session(CPUS, app="bench")
    seconds: dict[str, float] = {}

    start = time.time()
    warehouse = open_driver_warehouse(spark, FOLDER).build()
    seconds["build_warehouse"] = round(time.time() - start, 3)

    queries = entries()
    for name in HEADLINE:
        start = time.time()
        queries[name][0](warehouse).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)

    close_driver_warehouses(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "warehouse build and headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
