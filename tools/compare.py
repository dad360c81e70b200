"""Spark and DuckDB on the same queries, on equal terms.

    python tools/compare.py [--sf-dir DIR] [--cpus N] [--runs N] [key ...]

Both engines read the given Parquet files, do the stand-in mapping within the
query, use the same number of threads and drop the result where it is computed
(Spark's ``noop`` sink, a DuckDB temporary table).  Median of ``runs`` runs after
one that warms up.  ``empty job`` is a Spark query without data: the fixed cost of
planning and starting one job.
"""

from __future__ import annotations

import argparse
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def median(fn, runs: int) -> float:
    fn()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        fn()
        times.append(time.perf_counter() - start)
    return statistics.median(times)


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    args.add_argument("--cpus", type=int, default=8)
    args.add_argument("--runs", type=int, default=3)
    args.add_argument("keys", nargs="*")
    given = args.parse_args()

    import duckdb

    from bench import HEADLINE
    from emporium.plans.catalog import QUERIES
    from emporium.plans.oracle_queries import ORACLE
    from emporium.session import build_session
    from emporium.sources.standin import TEST_TABLES

    spark = build_session(f"local[{given.cpus}]", shuffle_partitions=given.cpus)
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    fixed = median(lambda: noop(spark.range(1)), given.runs)
    keys = given.keys or HEADLINE
    ours = {k: median(lambda k=k: noop(QUERIES[k](spark, given.sf_dir)), given.runs) for k in keys}
    spark.stop()

    con = duckdb.connect()
    con.execute(f"SET threads = {given.cpus}")
    for t in TEST_TABLES:
        path = os.path.join(given.sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    print(f"empty job: {fixed:.3f} s\n\n| key | Spark s | DuckDB s | ratio |\n| --- | --- | --- | --- |")
    total = [0.0, 0.0]
    for k in keys:
        theirs = median(lambda k=k: con.execute(f"CREATE OR REPLACE TEMP TABLE result AS {ORACLE[k]}"), given.runs)
        total = [total[0] + ours[k], total[1] + theirs]
        print(f"| `{k}` | {ours[k]:.3f} | {theirs:.3f} | {ours[k] / theirs:.2f} |", flush=True)
    print(f"| sum | {total[0]:.3f} | {total[1]:.3f} | {total[0] / total[1]:.2f} |")


if __name__ == "__main__":
    main()
