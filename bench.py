"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopledger.plans import registry  # noqa: E402
from shopledger.session import local_session  # noqa: E402

HEADLINE = [
    "priority_urgency", "late_orders_impact", "machine_utilization", "work_order_status", "pending_deliveries",
    "delivery_shipping_status", "vacation_filtered", "midnight_merge", "schedule_update", "output_rollup",
    "other_process_bonus", "payroll_summary", "sales_dense", "sales_by_dimension", "ols_by_category",
    "sarima_by_series", "inventory_balance", "stream_monitor",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    queries = registry.queries()
    queries["basic_overview"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
