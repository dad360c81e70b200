"""The driver contract: entry() smoke, and every query against its DuckDB oracle."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from emporium.plans.catalog import QUERIES
from emporium.plans.oracle_queries import ORACLE
from emporium.sources.standin import TEST_TABLES


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "order_id" in df.columns and "payment_installment_opted" in df.columns


def test_every_query_of_the_marts_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_oracle_shares_nothing_with_the_plans():
    for name in ("oracle_sql", "oracle_queries"):
        with open(os.path.join(os.path.dirname(entry.__file__), "emporium", "plans", f"{name}.py")) as f:
            imports = [x for x in f if x.startswith(("import ", "from "))]
        assert not [x for x in imports if "emporium" in x and "oracle_sql" not in x]


def _jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))


def test_building_a_query_runs_no_job(spark):
    spark.sparkContext.setJobGroup("building", "queries are only built")
    try:
        for query in QUERIES.values():
            query(spark, SF_SMALL)
        assert _jobs(spark) == 0
        QUERIES["chk_unique"](spark, SF_SMALL).count()
        assert _jobs(spark) > 0
    finally:
        spark.sparkContext._jsc.clearJobGroup()


# keys whose result says whether something failed: each shows both
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("key,column", [("rec_grain_parity", "row_count_matches"), ("rec_measure_propagation", "passed"), ("chk_known_orders", "passed"), ("suite_results", "passed")])
def test_checks_show_failing_and_passing_rows(spark, sf, key, column):
    found = {r[column] for r in QUERIES[key](spark, f"/root/testdata/{sf}").select(column).collect()}
    assert found == {True, False}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def _bag(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[key])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert _bag(got, df.columns) == _bag(want, names)
