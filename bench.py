"""Seconds per headline query: prints one JSON line.

``BENCH_SF_DIR`` names the sample folder and ``BENCH_CPUS`` the number of local cores.  Each query runs once to
warm up; the mean of three further runs counts.  ``gold_layer`` is the whole job from clean Parquet tables to written
analytical tables and the metrics record, comparable with the published baseline.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from tests.session import local_session
from tillhouse.functions.materialize import scratch_path
from tillhouse.plans import jobs
from tillhouse.workload.queries import QUERIES, write_clean_tables

HEADLINES = [
    "typed_cast",
    "null_profile",
    "null_policy",
    "dedup_kept",
    "dedup_rejected",
    "flag_reference",
    "business_flags",
    "total_revenue",
    "daily_sales",
    "revenue_per_user",
    "top_decile_share",
    "city_sales",
    "customer_metrics",
    "product_sales",
    "top_products_per_city",
    "order_buckets",
    "multi_product_share",
    "customer_loyalty",
    "run_kpis",
]
RUNS = 3


def seconds(action: Callable[[], None]) -> float:
    action()
    times = []
    for _ in range(RUNS):
        started = time.perf_counter()
        action()
        times.append(time.perf_counter() - started)
    return round(sum(times) / RUNS, 3)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "16g")
    wanted = sys.argv[1:]
    times = {
        name: seconds(lambda name=name: consume(QUERIES[name](spark, folder)))
        for name in HEADLINES
        if not wanted or name in wanted
    }
    if not wanted or "gold_layer" in wanted:
        root = scratch_path(spark, "bench")
        write_clean_tables(spark, folder, f"{root}/silver")
        times["gold_layer"] = seconds(lambda: jobs.gold(spark, f"{root}/silver", f"{root}/gold", f"{root}/reports"))
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rpartition("sf")[2],
            }
        )
    )


if __name__ == "__main__":
    main()
