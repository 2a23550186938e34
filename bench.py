"""Time the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (default 3,
the median counts) and ``BENCH_QUERIES`` (comma-separated names) may be set.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from salesmart.plans.driver_queries import QUERIES
from salesmart.session import build_session

HEADLINE = (
    "daily_summary", "daily_sales_report", "monthly_trend", "top_customers", "category_sales", "weekend_vs_weekday",
    "rfm_segments", "cohort_retention", "sales_velocity", "geo_sales", "discount_effectiveness", "product_affinity",
    "category_affinity", "quality_metrics", "customer_totals", "scd1_customer", "scd2_build", "scd2_apply", "cdc_apply",
    "point_in_time_join", "merge_daily_summary", "fact_sales", "run_datamart", "stream_fact_sales",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One run that does not count, so that the first query does not pay for starting the JVM.
    QUERIES["daily_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            # The noop sink computes every row and column without collecting them.
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "headline query time, median of runs, summed", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
