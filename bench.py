"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and fully materialized (``noop`` sink: every row is
computed, nothing is collected) once to warm up, then ``BENCH_RUNS`` times;
the median per query is reported.  Prints one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "fct_orders",
    "int_order_payments",
    "suite_results",
    "chk_orphaned_order_items",
    "rec_payments",
    "fct_order_items",
    "dim_products",
    "rec_grain_parity",
    "prof_key_duplicates",
    "chk_relationships",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]

    from emporium.session import build_session
    from emporium.plans.catalog import QUERIES

    spark = build_session(
        f"local[{cpus}]",
        app_name="emporium-bench",
        shuffle_partitions=cpus,
    )
    times: dict[str, float] = {}
    for key in only or HEADLINE:
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run warms up
                samples.append(time.perf_counter() - t0)
        times[key] = round(statistics.median(samples), 4)
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_sec",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
