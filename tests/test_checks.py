"""Every check with a passing and a failing input; the suite against brute force."""

from __future__ import annotations

from collections import Counter

from conftest import rows
from emporium.operators import checks as C
from emporium.plans.suite import ACCEPTED, COMBINATION, NOT_NULL, RELATIONSHIPS, UNIQUE, Check, run_suite


def df(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_unique(spark):
    ok = df(spark, [("a",), ("b",), (None,), (None,)], "k string")
    assert C.unique_violations(ok, "k").count() == 0  # nulls ignored
    bad = df(spark, [("a",), ("a",), ("a",), ("b",)], "k string")
    assert rows(C.unique_violations(bad, "k")) == [("a", 3)]


def test_unique_combination_keeps_null_parts(spark):
    ok = df(spark, [("o1", 1), ("o1", 2), ("o2", 1)], "a string, b int")
    assert C.unique_combination_violations(ok, ["a", "b"]).count() == 0
    bad = df(spark, [("o1", 1), ("o1", 1), ("o2", None), ("o2", None)], "a string, b int")
    want = sorted([("o1", 1, 2), ("o2", None, 2)], key=repr)
    assert rows(C.unique_combination_violations(bad, ["a", "b"])) == want


def test_not_null_and_fused_counts(spark):
    d = df(spark, [("a", 1), (None, 2), (None, None)], "x string, y int")
    assert C.not_null_violations(d.where("x is not null"), "x").count() == 0
    assert C.not_null_violations(d, "x").count() == 2
    assert rows(C.null_counts(d, ["x", "y"])) == [("x", 2), ("y", 1)]


def test_accepted_values(spark):
    ok = df(spark, [("shipped",), (None,)], "s string")
    assert C.accepted_values_violations(ok, "s", ["shipped"]).count() == 0  # null not reported
    bad = df(spark, [("shipped",), ("lost",), ("lost",)], "s string")
    assert rows(C.accepted_values_violations(bad, "s", ["shipped"])) == [("lost", 2)]


def test_relationships_ignore_null_fk_report_dangling(spark):
    parent = df(spark, [("c1",), ("c2",)], "customer_id string")
    ok = df(spark, [("o1", "c1"), ("o2", None)], "order_id string, customer_id string")
    assert C.relationship_violations(ok, "customer_id", parent, "customer_id").count() == 0
    bad = df(spark, [("o1", "c9"), ("o2", "c9"), ("o3", "c1")], "order_id string, customer_id string")
    assert rows(C.relationship_violations(bad, "customer_id", parent, "customer_id")) == [("c9", 2)]


def test_orphan_assertion_reports_null_and_dangling(spark):
    orders = df(spark, [("o1",), ("o2",)], "order_id string")
    ok = df(spark, [("o1", 1), ("o2", 1)], "order_id string, order_item_id int")
    assert C.orphaned_order_items(ok, orders).count() == 0
    bad = df(spark, [("o1", 1), ("o9", 1), ("o9", 2), (None, 1)], "order_id string, order_item_id int")
    want = sorted([(None, 1), ("o9", 1), ("o9", 2)], key=repr)
    assert rows(C.orphaned_order_items(bad, orders)) == want
    plan = C.orphaned_order_items(bad, orders)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "LogicalRDD" in plan


def _checked(models, ch):
    d, col = models[ch.model], ch.columns[0]
    if ch.kind == NOT_NULL:
        return C.not_null_violations(d, col)
    if ch.kind == UNIQUE:
        return C.unique_violations(d, col)
    if ch.kind == COMBINATION:
        return C.unique_combination_violations(d, ch.columns)
    if ch.kind == ACCEPTED:
        return C.accepted_values_violations(d, col, ch.values)
    return C.relationship_violations(d, col, models[ch.to], ch.field)


def test_negative_payments_only_negative(spark):
    d = df(spark, [("o1", -0.01), ("o2", 0.0), ("o3", None), ("o4", 5.0)], "order_id string, total_paid_amount double")
    assert rows(C.negative_payment_totals(d)) == [("o1", -0.01)]
    assert C.negative_payment_totals(d.where("order_id <> 'o1'")).count() == 0


def test_lookup_fanout(spark):
    ok = df(spark, [("a", "A"), ("b", "B")], "k string, v string")
    assert C.lookup_fanout(ok, "k").count() == 0
    bad = df(spark, [("a", "A"), ("a", "AA")], "k string, v string")
    assert rows(C.lookup_fanout(bad, "k")) == [("a", 2)]


def _brute_force(models, suite):
    """Pure-Python evaluation of the suite over collected small models."""
    data = {name: [r.asDict() for r in frame.collect()] for name, frame in models.items()}
    out = {}
    for ch in suite:
        rs = data[ch.model]
        c = ch.columns[0]
        if ch.kind == NOT_NULL:
            f = sum(r[c] is None for r in rs)
        elif ch.kind == UNIQUE:
            f = sum(n > 1 for n in Counter(r[c] for r in rs if r[c] is not None).values())
        elif ch.kind == COMBINATION:
            f = sum(n > 1 for n in Counter(tuple(r[x] for x in ch.columns) for r in rs).values())
        elif ch.kind == ACCEPTED:
            f = len({r[c] for r in rs if r[c] is not None and r[c] not in ch.values})
        elif ch.kind == RELATIONSHIPS:
            parents = {r[ch.field] for r in data[ch.to]}
            f = sum(r[c] is not None and r[c] not in parents for r in rs)
        out[ch.check_id] = f
    return out


def test_suite_runner_matches_brute_force(spark):
    models = {
        "orders": df(spark, [("o1", "c1", "shipped"), ("o1", "c2", "lost"), ("o2", None, None), ("o3", "c9", "lost")],
                     "order_id string, customer_id string, status string"),
        "customers": df(spark, [("c1",), ("c2",), ("c2",)], "customer_id string"),
        "items": df(spark, [("o1", 1), ("o1", 1), ("o2", None), ("o2", None), ("o4", 1)], "order_id string, n int"),
        "empty": df(spark, [], "k string"),
    }
    suite = [
        Check("orders", UNIQUE, ("order_id",)),
        Check("orders", NOT_NULL, ("customer_id",)),
        Check("orders", NOT_NULL, ("status",)),
        Check("orders", ACCEPTED, ("status",), values=("shipped",)),
        Check("orders", RELATIONSHIPS, ("customer_id",), to="customers", field="customer_id"),
        Check("customers", UNIQUE, ("customer_id",)),
        Check("items", COMBINATION, ("order_id", "n")),
        Check("items", RELATIONSHIPS, ("order_id",), to="orders", field="order_id"),
        Check("empty", UNIQUE, ("k",)),
    ]
    got = {r.check_id: (r.failures, r.passed, r.model, r.kind) for r in run_suite(models, suite).collect()}
    want = _brute_force(models, suite)
    assert {k: v[0] for k, v in got.items()} == want
    assert all(v[1] == (v[0] == 0) for v in got.values())
    # the violations frames count the same failures
    assert {ch.check_id: C.failures(_checked(models, ch), ch.kind).first().failures for ch in suite} == want
    assert got["unique__empty__k"] == (0, True, "empty", "unique")
    assert want["relationships__items__order_id"] == 1 and want["unique_combination__items__order_id__n"] == 2
