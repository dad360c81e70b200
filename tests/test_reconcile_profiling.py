"""Reconciliation (M1-M10) and profiling (N1-N5) on small hand-written frames."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from emporium.functions.expressions import is_close, surrogate_key
from emporium.operators import profiling as P
from emporium.operators import reconcile as R
from emporium.session import file_bytes


def df(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize(
    "a,b",
    [(0.0, 0.01), (0.0, 0.0100001), (1e12, 1e12 + 500), (100.0, 100.005), (None, 1.0), (5.0, 4.99)],
)
def test_is_close_equals_python(spark, a, b):
    got = df(spark, [(a, b)], "a double, b double").select(is_close("a", "b").alias("c")).first().c
    want = None if a is None or b is None else math.isclose(a, b, abs_tol=0.01)
    assert got == want


def test_surrogate_key_matches_md5_of_text(spark):
    import hashlib

    r = df(spark, [("o1", "r1")], "a string, b string").select(surrogate_key("a", "b").alias("k")).first()
    assert r.k == hashlib.md5(b"o1~r1").hexdigest()


def test_payment_reconciliation_both_directions(spark):
    fct = df(
        spark,
        [("o1", 10.0), ("o2", 10.02), ("o3", None), ("o4", 0.02)],
        "order_id string, total_paid_amount double",
    )
    pay = df(
        spark,
        [("o1", "4.995"), ("o1", "5.0"), ("o2", "10.0"), ("o5", "3.0"), (None, "1.0")],
        "order_id string, payment_value string",
    )
    out = {r.order_id: r.issue for r in R.payment_reconciliation(fct, pay).collect()}
    # o1 differs by 0.005 (ok), o2 by 0.02 (mismatch), o3 null vs none (ok),
    # o4 0.02 vs none (mismatch), o5 paid for an unknown order
    assert out == {"o2": "amount_mismatch", "o4": "amount_mismatch", "o5": "payment_without_order"}


def test_grain_parity_sees_fanout_and_null_parts(spark):
    base = df(spark, [("o1", 1), ("o1", None), ("o1", None)], "order_id string, n int")
    clean = base.distinct()
    dup = base.unionByName(base)
    got = {r.layer: r for r in R.grain_parity([("raw", base), ("clean", clean), ("dup", dup)], ["order_id", "n"]).collect()}
    # (o1, null) twice counts as one distinct pair, not zero
    assert got["raw"].distinct_keys == 2 and got["raw"].row_count == 3
    assert got["clean"].row_count_matches is False and got["clean"].distinct_keys_match is True
    assert got["dup"].row_count == 6 and got["dup"].distinct_keys_match is True


def test_orphans_by_marker_matches_anti_join(spark):
    from emporium.operators.checks import orphaned_order_items

    orders = df(spark, [("o1",), ("o1",), ("o2",)], "order_id string")
    items = df(spark, [("o1", 1), ("o3", 1), (None, 2)], "order_id string, order_item_id int")
    assert rows(R.orphans_by_marker(items, orders)) == rows(orphaned_order_items(items, orders))


def test_mart_parity(spark):
    mart = df(spark, [("a",), ("b",), ("b",)], "k string")
    src = df(spark, [("a",), ("b",), ("b",)], "k string")
    got = R.mart_parity([("m", mart, src, "k")]).first()
    assert (got.mart_rows, got.source_keys, got.ok) == (3, 2, False)


def test_measure_propagation_null_safe(spark):
    fct = df(
        spark,
        [("o1", 1, 2.0, 0.0, 5.0, 1, 1, False, 1), ("o2", None, None, None, None, None, None, None, None)],
        "order_id string, item_count long, total_item_value double, total_freight_value double, "
        "total_paid_amount double, payment_installments_count long, credit_card_count long, "
        "payment_installment_opted boolean, distinct_payment_types_count long",
    )
    items = df(spark, [("o1", 1, 2.0, 0.0)], "order_id string, item_count long, total_item_value double, total_freight_value double")
    pays = fct.where("order_id = 'o1'").drop("item_count", "total_item_value", "total_freight_value")
    r = R.measure_propagation(fct, items, pays).first()
    assert (r.orders_checked, r.item_mismatches, r.payment_mismatches, r.passed) == (2, 0, 0, True)
    bad_items = items.withColumn("item_count", F.lit(7).cast("long"))
    assert R.measure_propagation(fct, bad_items, pays).first().item_mismatches == 1


def test_resolve_prefixes(spark):
    ids = df(spark, [("abc1",), ("abc2",), ("abd",), ("x_y",), ("xzy",), ("ABD",)], "id string")
    got = {r.prefix: (r.status, r.n_matches, r.resolved_id) for r in R.resolve_prefixes(ids, "id", ["abd", "abc", "zz", "x_"]).collect()}
    assert got == {
        "abd": ("ok", 1, "abd"),
        "abc": ("ambiguous", 2, None),
        "zz": ("missing", 0, None),
        "x_": ("ok", 1, "x_y"),  # '_' is literal, not a wildcard
    }
    ci = {r.prefix: r.status for r in R.resolve_prefixes(ids, "id", ["abd"], case_insensitive=True).collect()}
    assert ci == {"abd": "ambiguous"}


def test_known_answers(spark):
    actual = df(spark, [("o1", 879.44, 5, 1, True, 2)], R.PAYMENT_EXPECTATION_SCHEMA)
    exp = df(
        spark,
        [("o1", 879.445, 5, None, True, 3), ("o9", None, None, None, None, None)],
        R.PAYMENT_EXPECTATION_SCHEMA,
    )
    got = {r.order_id: r for r in R.known_answers(actual, exp).collect()}
    o1 = got["o1"]
    assert o1.found and o1.total_paid_amount_ok and o1.credit_card_count_ok
    assert o1.distinct_payment_types_count_ok is False and o1.passed is False
    assert got["o9"].found is False and got["o9"].passed is False


def test_repeated_expectations_give_a_row_each(spark):
    actual = df(spark, [("o1", 10.0, 1, 1, False, 1)], R.PAYMENT_EXPECTATION_SCHEMA)
    exp = df(spark, [("o1", 10.0, None, None, None, None), ("o1", 11.0, None, None, None, None)], R.PAYMENT_EXPECTATION_SCHEMA)
    assert rows(R.known_answers(actual, exp), "order_id", "passed") == [("o1", False), ("o1", True)]
    assert R.of_expected_keys(actual, exp).count() == 1


def test_suite_summary(spark):
    res = df(spark, [("a", "m1", True), ("b", "m1", False), ("c", "m2", True)], "check_id string, model string, passed boolean")
    got = {r.model: (r.checks, r.failed_checks, r.passed) for r in R.suite_summary(res).collect()}
    assert got == {"m1": (2, 1, False), "m2": (1, 0, True), "*": (3, 1, False)}


def test_null_profile(spark):
    d = df(spark, [("a", None, 1), (None, None, 2)], "x string, y string, z int")
    assert rows(P.null_profile(d, "t")) == [("t", "*", 3, 2), ("t", "x", 1, 2), ("t", "y", 2, 2)]
    assert rows(P.null_profile(d.select("z"), "clean")) == [("clean", "*", 0, 2)]


def test_key_duplicates_distinguish_null_positions(spark):
    d = df(spark, [("1", None), ("1", None), (None, "1"), ("2", "2")], "a string, b string")
    got = rows(P.key_duplicates({"t": (d, ["a", "b"])}))
    assert got == [("t", "a,b", '"1",null', 2)]


def test_key_duplicates_of_larger_tables_take_more_partitions(spark, tmp_path, monkeypatch):
    """A task counts a bounded number of keys, however large the table."""
    monkeypatch.setattr(P, "KEY_BYTES", 20_000)
    parts = []
    for n in (10_000, 40_000):
        ids = spark.range(n).selectExpr("if(id < 3, null, id) as a", "cast(id % 7 as int) as b")
        ids.unionByName(ids.where("a % 10000 = 5")).write.parquet(str(tmp_path / str(n)))
        d = spark.read.parquet(str(tmp_path / str(n)))
        parts.append(P.dealt_by_key(d, ["a"]).rdd.getNumPartitions())
        assert parts[-1] == -(-file_bytes(d) // 20_000)
        got = rows(P.key_duplicates({"t": (d, ["a"])}), "key_value", "n_records")
        assert got == sorted([("null", 3), *(('"%d"' % i, 2) for i in range(5, n, 10_000))], key=repr)
    assert parts[1] >= 3 * parts[0] > 3


def test_key_text_is_never_ambiguous(spark):
    keys = [("a|b", "c"), ("a", "b|c"), ('a","b', "c"), ("a", 'b","c'), ("null", None), (None, "null"), ("a\\", "b"), ("a", "\\b")]
    texts = [r[0] for r in df(spark, keys, "a string, b string").select(P.key_text(["a", "b"])).collect()]
    assert len(set(texts)) == len(keys)


def test_casing_variants(spark):
    d = df(spark, [("Sao Paulo",), ("sao paulo ",), ("SAO PAULO",), ("rio",), ("rio",)], "city string")
    assert rows(P.casing_variants([("t", d, "city")])) == [("t", "city", "sao paulo", 3)]


def test_domains(spark):
    d = df(spark, [("a", 1), ("b", 1), ("a", None)], "s string, n int")
    got = rows(P.domains([("t", d, "s"), ("t", d, "n")]))
    assert got == sorted([("t", "s", "a"), ("t", "s", "b"), ("t", "n", "1"), ("t", "n", None)], key=repr)


def test_shared_ids_top_k(spark):
    d = df(spark, [("r1", "o2"), ("r1", "o1"), ("r2", "o3"), ("r0", "o9"), ("r0", "o8")], "review_id string, order_id string")
    got = [tuple(r) for r in P.shared_ids(d, "review_id", ["order_id"], ["review_id", "order_id"], top=3).collect()]
    assert got == [("r0", "o8"), ("r0", "o9"), ("r1", "o1")]
    assert P.shared_ids(d, "review_id", ["order_id"], ["review_id"], top=None).count() == 4


def test_rows_with_bound_value_and_preview(spark):
    d = df(spark, [("o1'; drop", 1), ("o2", 2), ("o3", 3)], "order_id string, n int")
    assert rows(P.rows_with_value(d, "order_id", "o1'; drop")) == [("o1'; drop", 1)]
    assert [tuple(r) for r in P.preview(d, 2, "n").collect()] == [("o1'; drop", 1), ("o2", 2)]


def test_null_count_expression(spark):
    from emporium.functions.expressions import null_count

    d = df(spark, [(None,), ("a",), (None,)], "x string")
    assert d.agg(null_count("x").alias("n")).first().n == 2


def test_register_views(spark):
    from emporium.plans.project import register_views

    m = {"tiny_model": df(spark, [("a",)], "x string")}
    assert register_views(m) == ["tiny_model"]
    assert spark.sql("SELECT count(*) AS n FROM tiny_model").first().n == 1


def test_has_prefix_plain_and_case_insensitive(spark):
    from emporium.functions.expressions import has_prefix

    d = df(spark, [("Abc%1",), ("abcx",), (None,)], "id string")
    got = [tuple(r) for r in d.select(has_prefix("id", F.lit("Abc%")).alias("a"), has_prefix("id", F.lit("abc"), True).alias("b")).collect()]
    assert got == [(True, True), (False, True), (None, None)]


def test_prefixes_become_ranges_in_the_scan(spark, tmp_path):
    """Few case-sensitive prefixes reach the files' row groups; results are those of a plain match."""
    ids = ["", "a", "ab", "ab%c", "abz", "ac", "a_", "b퟿", "bx", "b\U0010ffff", "b\U0010ffffy", "c", "C", "é", None, "ab"]
    path = str(tmp_path / "ids.parquet")
    spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1).write.parquet(path)
    prefixes = ["ab", "a_", "b퟿", "b\U0010ffff", "\U0010ffff", "", "é", "zz", "ab", "C"]
    frame = spark.read.parquet(path)
    got = R.resolve_prefixes(frame, "id", prefixes)
    want = []
    for p in dict.fromkeys(prefixes):
        hits = {i for i in ids if i is not None and i.startswith(p)}
        want.append((p, {0: "missing", 1: "ok"}.get(len(hits), "ambiguous"), len(hits), hits.pop() if len(hits) == 1 else None))
    assert rows(got) == sorted(want, key=repr)
    some = R.resolve_prefixes(frame, "id", ["ab", "zz"])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(id,ab),LessThan(id,ac)),And(GreaterThanOrEqual(id,zz),LessThan(id,z{)))]" in plan
    many = [f"p{i}" for i in range(R.MOST_RANGES)] + ["ab", "a_"]
    assert {r["prefix"]: r["n_matches"] for r in R.resolve_prefixes(frame, "id", many).where("n_matches > 0").collect()} == {"ab": 3, "a_": 1}


def test_reconciliation_works_each_side_out_once(spark):
    from emporium.plans.catalog import models

    m = models(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = R.payment_reconciliation(m["fct_orders"], m["stg_payments"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FullOuter") == 1 and "LeftAnti" not in plan


def test_reconciliation_reports_null_orders_of_the_fact(spark):
    fact = spark.createDataFrame([("a", 5.0), ("b", 1.0), (None, 3.0), (None, 0.001), (None, None), ("c", None)], "order_id string, total_paid_amount double")
    paid = spark.createDataFrame([("a", "2.5"), ("a", "2.5"), ("b", "1.5"), ("d", "0.0"), (None, "9"), ("c", "0.001")], "order_id string, payment_value string")
    got = rows(R.payment_reconciliation(fact, paid))
    assert got == sorted([("b", "amount_mismatch", 1.0, 1.5), (None, "amount_mismatch", 3.0, 0.0), ("d", "payment_without_order", 0.0, 0.0)], key=repr)
