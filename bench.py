"""Benchmark: run the headline queries on the driver tables, print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is forced end to end with the ``noop`` sink (no collect to the driver). A run starts
with an empty mart store: ``marts_build`` is the time to clean the raw exports and write the
shared marts, which the queries then read; building a query (which may run jobs) counts too.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a10_store_day",
    "a11_store_hour",
    "a12_store_month_kpis",
    "a15_kpi_sql",
    "q06_quarantine_lines",
    "c01_customer_segments",
    "d02_sales_anomalies",
    "x01_scenario_grid",
    "x06_profit_bridges",
    "m03_promotion_effectiveness",
    "l02_hourly_plan",
    "e03_transition_audit",
    "f01_feature_matrix",
    "e08_action_register",
]

# shared tables that most queries read; each access writes its table once
MARTS = ["sales_lines", "flagged", "transactions", "labour", "orders", "store_day", "store_hour", "store_month_kpis"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("OPSLEDGER_SHUFFLE", str(cpus))
    from opsledger.plans import registry
    from opsledger.plans.context import Context
    from opsledger.session import local_session

    registry.load_all()
    spark = local_session(cpus, app="opsledger-bench")
    # warm up the JVM and the parquet footers once
    registry.QUERIES["p13_calendar"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    t0 = time.perf_counter()
    ctx = Context(spark, folder)
    for mart in MARTS:
        getattr(ctx, mart)
    times["marts_build"] = round(time.perf_counter() - t0, 3)
    for name in HEADLINE:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
