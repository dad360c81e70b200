"""Versioned publishing: all marts or none, checks counted while writing."""

from __future__ import annotations

import os
import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from emporium.operators import joins as J
from emporium.operators import marts as M
from emporium.plans import publish as P
from emporium.plans.catalog import models
from emporium.plans.project import MARTS, Models
from emporium.plans.suite import ACCEPTED, NOT_NULL, SUITE, run_suite


def _scratch() -> str:
    return tempfile.mkdtemp(prefix="publish-")


def _with(m, **changed) -> Models:
    """The models ``m``, some replaced."""
    return Models({name: (lambda _, name=name: changed.get(name, m[name])) for name in m})


def _failing(df):
    """``df``, failing when a task reads its rows."""
    column = df.columns[0]
    return df.withColumn(column, F.when(F.lit(True), F.raise_error(F.lit("executor lost"))).otherwise(F.col(column)))


def _same(one, two) -> bool:
    return one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_failure_between_two_marts_leaves_the_old_version(spark):
    out, m = _scratch(), models(spark, SF_SMALL)
    assert P.published(spark, out) is None
    first, _ = P.publish(spark, m, out, blocking=())
    fewer = _with(m, dim_customers=m["dim_customers"].where("customer_id > '5'"), fct_orders=_failing(m["fct_orders"]))
    with pytest.raises(Exception, match="executor lost"):
        P.publish(spark, fewer, out, blocking=())
    now = P.published(spark, out)
    assert now.version == first.version and set(now) == set(MARTS)
    for name in MARTS:
        assert _same(now[name], m[name])
    # a rerun succeeds, and readers then see all marts of the new version
    fewer = _with(m, dim_customers=m["dim_customers"].where("customer_id > '5'"))
    second, _ = P.publish(spark, fewer, out, blocking=())
    now = P.published(spark, out)
    assert now.version == second.version != first.version and now.number == 2
    assert now["dim_customers"].count() < m["dim_customers"].count() and _same(now["fct_orders"], m["fct_orders"])
    # readers of the first version are not disturbed until it is dropped
    assert _same(first["dim_customers"], m["dim_customers"])
    assert len(os.listdir(os.path.join(out, "versions"))) == 3
    assert P.drop_versions(spark, out, keep=1) == [first.version]
    assert len(P.drop_versions(spark, out, keep=1, unfinished=True)) == 1
    assert os.listdir(os.path.join(out, "versions")) == [second.version]
    assert _same(P.published(spark, out)["dim_sellers"], m["dim_sellers"])
    with pytest.raises(ValueError):
        P.drop_versions(spark, out, keep=0)


def test_failing_checks_block_the_commit(spark):
    out, m = _scratch(), models(spark, SF_SMALL)
    bad = _with(m, fct_orders=m["fct_orders"].withColumn("total_paid_amount", F.lit(-1.0)).withColumn("order_status", F.lit(None).cast("string")))
    with pytest.raises(P.ChecksFailed, match=f"{P.NEGATIVE}.*not_null__fct_orders__order_status"):
        P.publish(spark, bad, out, blocking=(P.NEGATIVE, "not_null__fct_orders__order_status", "not_null__stg_orders__order_id"))
    assert P.published(spark, out) is None
    done, results = P.publish(spark, bad, out, blocking=("not_null__stg_orders__order_id",))
    found = {r["check_id"]: r["failures"] for r in results.collect()}
    assert found[P.NEGATIVE] == found["not_null__fct_orders__order_status"] == done["fct_orders"].count()
    assert found[P.ORPHANS] == 0 and len(found) == 55


def test_of_two_publishers_one_commits(spark):
    out, m = _scratch(), models(spark, SF_SMALL)
    one, two = P.stage(spark, m, out), P.stage(spark, m, out)
    P.commit(spark, out, two, after=0)
    with pytest.raises(P.CommitConflict):
        P.commit(spark, out, one, after=0)
    assert P.published(spark, out).version == two.version
    assert [x for x in os.listdir(os.path.join(out, "commits")) if not x.endswith((".json", ".crc"))] == []


def test_observed_checks_equal_the_suite_and_are_not_scanned(spark):
    out, m = _scratch(), models(spark, SF_SMALL)
    staged = P.stage(spark, _with(m, dim_sellers=m["dim_sellers"].withColumn("seller_id", F.when(F.col("seller_id") > "5", F.col("seller_id")))), out)
    counted = {ch.check_id for ch in SUITE if ch.model in MARTS and ch.kind == NOT_NULL}
    assert counted <= set(staged.failures)
    assert staged.rows == {name: staged.marts[name].count() for name in MARTS}
    whole = {name: staged.marts.get(name, m[name]) for name in m}
    scanned = {r["check_id"]: r["failures"] for r in run_suite(whole).collect()}
    observed = P.check_staged(staged, m)
    assert {r["check_id"]: r["failures"] for r in observed.collect()} == scanned
    assert scanned["not_null__dim_sellers__seller_id"] > 0
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert scans(observed) == scans(run_suite(whole)) - len({ch.model for ch in SUITE if ch.model in MARTS and ch.kind == NOT_NULL})


def test_accepted_values_without_a_failure_are_not_scanned(spark):
    out, m = _scratch(), models(spark, SF_SMALL)
    check = next(ch.check_id for ch in SUITE if ch.kind == ACCEPTED)
    assert check not in P.stage(spark, m, out).failures  # the given statuses are not in the list
    good = _with(m, fct_orders=m["fct_orders"].withColumn("order_status", F.lit("shipped")))
    assert P.stage(spark, good, out).failures[check] == 0


def test_bucketed_versions(spark):
    out, m = _scratch(), models(spark, SF_SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS versions_test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.raises(ValueError):
            P.stage(spark, m, out, bucket_facts=4)
        P.publish(spark, m, out, (), bucket_facts=4, database="versions_test")
        P.publish(spark, m, out, (), bucket_facts=4, database="versions_test")
        now = P.published(spark, out)
        plan = now["fct_order_items"].join(now["fct_orders"], "order_id", "left_anti")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        assert all(_same(now[name], m[name]) for name in MARTS)
        assert spark.sql("SHOW TABLES IN versions_test").count() == 4
        P.drop_versions(spark, out, keep=1)
        assert spark.sql("SHOW TABLES IN versions_test").count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE IF EXISTS versions_test CASCADE")


def _products(spark, lookup):
    products = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p3", None), ("p4", "unknown")], "product_id string, product_category_name string")
    sizes = [F.lit(1.0).alias(c) for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")]
    names = spark.createDataFrame(lookup, "product_category_name string, product_category_name_english string")
    return M.dim_products(products.select("*", *sizes, F.lit(1).alias("product_photos_qty")), names)


def test_repeated_lookup_key_fails_within_the_plan(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("guard", "the plan is only built")
    try:
        repeated = _products(spark, [("a", "x"), ("a", "y"), ("c", "z")])
        unused = _products(spark, [("a", "x"), ("c", "z"), ("c", "z")])
        good = _products(spark, [("a", "x"), (None, "n"), (None, "m")])
        assert not tracker.getJobIdsForGroup("guard")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    for frame in (repeated, unused):
        with pytest.raises(Exception, match="several rows of product_category_name"):
            frame.collect()
    assert {r["product_id"]: r["product_category_name"] for r in good.collect()} == {"p1": "x", "p2": "b", "p3": None, "p4": "unknown"}


def _hot_lines(spark, n: int = 40_000):
    """Lines of which one order holds a third, and one a tenth; some have no order."""
    order = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm").when(F.col("id") % 997 == 2, F.lit(None)).otherwise((F.col("id") % 7000).cast("string"))
    lines = spark.range(n, numPartitions=8).select(order.alias("order_id"), F.col("id").cast("int").alias("order_item_id"))
    columns = [F.lit(c).alias(c) for c in ("product_id", "seller_id")] + [F.lit(1.0).alias(c) for c in ("price", "freight_value")]
    return lines.select("*", *columns)


def test_hot_keys_are_found_exactly(spark):
    lines = _hot_lines(spark)
    assert J.hot_keys(lines, "order_id", 16) == ["hot", "warm"] and J.hot_keys(lines, "order_id", 8) == ["hot"]
    assert J.hot_keys(lines.limit(0), "order_id", 8) == [] and J.hot_keys(lines.where("order_id is null"), "order_id", 8) == []
    even = spark.range(5000).select((F.col("id") % 50).cast("string").alias("order_id"))
    assert J.hot_keys(even, "order_id", 50) == [] and len(J.hot_keys(even, "order_id", 51)) == 50


def test_hot_orders_are_published_next_to_the_buckets(spark):
    out, m = _scratch(), models(spark, SF_SMALL)
    lines = _hot_lines(spark).cache()
    known = lines.select("order_id").where("order_id is not null and order_id > '3'").distinct()
    orders = known.select("order_id", *(F.lit(None).cast(f.dataType).alias(f.name) for f in m["fct_orders"].schema.fields if f.name != "order_id"))
    spark.sql("CREATE DATABASE IF NOT EXISTS hot_test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, results = P.publish(spark, _with(m, fct_order_items=lines, fct_orders=orders), out, (), bucket_facts=8, database="hot_test")
        now = P.published(spark, out)
        assert now.hot == ["fct_order_items"] and _same(now["fct_order_items"], lines)
        cold, hot = now.slices("fct_order_items")
        assert {r["order_id"] for r in hot.select("order_id").distinct().collect()} == {"hot"}
        # no bucket is over twice the median one, and the hot order is spread over files
        sizes = sorted(r["n"] for r in cold.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect())
        assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        files = sorted(r["n"] for r in hot.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect())
        assert len(files) == 8 and files[-1] <= 2 * files[len(files) // 2]
        plain = lines.join(orders, "order_id", "left_anti")
        joined = J.join_slices(cold, hot, now["fct_orders"], "order_id", "left_anti")
        assert _same(joined, plain) and plain.count() > 0
        bucketed = cold.join(now["fct_orders"], "order_id", "left_anti")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in bucketed
        for how in ("inner", "left", "left_semi"):
            assert _same(J.join_slices(cold, hot, now["fct_orders"], "order_id", how), lines.join(orders, "order_id", how))
        with pytest.raises(ValueError):
            J.join_slices(cold, hot, now["fct_orders"], "order_id", "full")
        found = {r["check_id"]: r["failures"] for r in results.collect()}
        assert found[P.ORPHANS] == plain.count()
        rows = {r["table_name"]: r["row_count"] for r in P.null_profile(spark, now).collect()}
        assert (rows["fct_order_items"], rows["fct_order_items__hot"]) == (cold.count(), hot.count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE IF EXISTS hot_test CASCADE")
        lines.unpersist()
