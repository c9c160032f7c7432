"""Time the headline queries and one full batch run; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated subset).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from depotlens.plans.daily_run import run_pipeline  # noqa: E402
from depotlens.plans.queries import CFG, QUERIES, RUN_TS, fit_demand_model  # noqa: E402
from depotlens.session import build_session  # noqa: E402
from depotlens.sources.sales_log import sales_log  # noqa: E402

HEADLINE = [
    "route_orders",
    "validation_report",
    "products",
    "orders",
    "order_items",
    "store_daily_metrics",
    "top_products",
    "demand_panel",
    "inventory_snapshots",
    "inventory_analysis",
    "store_profitability",
    "cross_store_correlation",
    "dense_pairs",
    "demand_features",
    "seasonal_naive_eval",
    "policy_comparison",
    "sales_summary",
    "inventory_summary",
    "headline_figures",
    "weekly_revenue",
    "orphan_items",
    "quality_report",
    "upsert_merge",
    "forecast_evaluation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join([*HEADLINE, "fit", "full_run"])).split(",") if n]
    spark = build_session(
        "depotlens-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["route_orders"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    seconds = {}
    for name in names:
        began = time.perf_counter()
        if name == "fit":
            fit_demand_model(spark, sf_dir)
        elif name == "full_run":
            # The same scope as the reference's first full run: log to checked tables, marts, model and policies.
            root = tempfile.mkdtemp(prefix="depotlens-bench-")
            cfg = replace(CFG, max_invalid_ratio=0.05)
            run_pipeline(spark, sales_log(spark, sf_dir, "type"), root, cfg, RUN_TS)
        else:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
