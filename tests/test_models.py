"""Staging, intermediate and mart models on hand-written raw frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from emporium.operators import intermediate as I
from emporium.operators import marts as M
from emporium.operators import staging as S
from emporium.plans.project import build_models, guard_lookup_fanout
from emporium.sources.schemas import RAW_SCHEMAS


def raw(spark, name, data):
    return spark.createDataFrame(data, RAW_SCHEMAS[name])


def payments(spark, data):
    return S.stg_payments(raw(spark, "raw_payments", data))


def test_stg_orders_casts_text_to_timestamp_ntz(spark):
    df = S.stg_orders(
        raw(
            spark,
            "raw_orders",
            [("o1", "c1", "delivered", "2017-10-02 10:56:33", None, None, None, "2017-10-18 00:00:00")],
        )
    )
    assert dict(df.dtypes)["order_purchase_at"] == "timestamp_ntz"
    r = df.collect()[0]
    assert r.order_purchase_at == dt.datetime(2017, 10, 2, 10, 56, 33)
    assert r.order_approved_at is None


def test_malformed_timestamp_fails_instead_of_null(spark):
    df = S.stg_orders(
        raw(spark, "raw_orders", [("o1", "c1", "created", "not a date", None, None, None, "x")])
    )
    with pytest.raises(Exception):
        df.collect()


def test_malformed_number_fails(spark):
    df = payments(spark, [("o1", 1, "voucher", 1, "12,5")])
    with pytest.raises(Exception):
        df.collect()


def test_known_order_single_card_among_vouchers(spark):
    # 11 vouchers at 1 installment + 1 card at 5: installments 5, not 16
    data = [("K1", i, "voucher", 1, "70.0") for i in range(1, 12)]
    data.append(("K1", 12, "credit_card", 5, "109.44"))
    r = I.int_order_payments(payments(spark, data)).collect()[0]
    assert r.total_paid_amount == pytest.approx(879.44, abs=0.01)
    assert (r.payment_installments_count, r.credit_card_count) == (5, 1)
    assert (r.distinct_payment_types_count, r.payment_installment_opted) == (2, True)


def test_known_order_two_cards_add_installments(spark):
    data = [("K2", 1, "credit_card", 10, "50.0"), ("K2", 2, "credit_card", 1, "25.0")]
    r = I.int_order_payments(payments(spark, data)).collect()[0]
    assert (r.payment_installments_count, r.credit_card_count, r.payment_installment_opted) == (
        11,
        2,
        True,
    )


@pytest.mark.parametrize("distinct_types", ["set", "exact"])
def test_payment_edge_cases(spark, distinct_types):
    data = [
        ("one_card", 1, "credit_card", 1, "10.0"),
        ("vouchers", 1, "voucher", 1, "5.0"),
        ("vouchers", 2, "voucher", 1, "5.0"),
        ("null_type", 1, None, 3, "1.0"),
        ("null_type", 2, "boleto", 1, "1.0"),
        ("null_inst", 1, "credit_card", None, "1.0"),
        ("float", 1, "boleto", 1, "0.1"),
        ("float", 2, "boleto", 1, "0.2"),
    ]
    out = {
        r.order_id: r
        for r in I.int_order_payments(payments(spark, data), distinct_types).collect()
    }
    assert (out["one_card"].payment_installments_count, out["one_card"].payment_installment_opted) == (1, False)
    v = out["vouchers"]
    assert (v.payment_installments_count, v.credit_card_count, v.payment_installment_opted) == (0, 0, False)
    n = out["null_type"]
    assert (n.credit_card_count, n.distinct_payment_types_count, n.payment_installments_count) == (0, 1, 0)
    c = out["null_inst"]
    assert c.payment_installments_count is None and c.payment_installment_opted is None
    assert out["float"].total_paid_amount == 0.3


def test_items_summary_sums_unrounded_then_rounds(spark):
    data = [
        ("o1", 1, "p", "s", "2018-01-01 00:00:00", "0.104", "1.0"),
        ("o1", 2, "p", "s", "2018-01-01 00:00:00", "0.104", "2.0"),
    ]
    items = S.stg_order_items(raw(spark, "raw_order_items", data))
    r = I.int_order_items_summary(items).collect()[0]
    assert (r.item_count, r.total_item_value, r.total_freight_value) == (2, 0.21, 3.0)
    assert [x.price for x in I.int_order_items(items).collect()] == [0.1, 0.1]


def test_review_key_keeps_grain_and_propagates_null(spark):
    data = [
        ("r1", "o1", 5, None, None, "2018-01-01 00:00:00", "2018-01-02 00:00:00"),
        ("r1", "o2", 4, None, None, "2018-01-01 00:00:00", "2018-01-02 00:00:00"),
        (None, "o3", 3, None, None, "2018-01-01 00:00:00", "2018-01-02 00:00:00"),
    ]
    out = {r.order_id: r.order_review_id for r in I.int_order_reviews(S.stg_reviews(raw(spark, "raw_reviews", data))).collect()}
    import hashlib

    assert out["o1"] == hashlib.md5(b"o1~r1").hexdigest()
    assert out["o1"] != out["o2"]
    assert out["o3"] is None


def _raw_world(spark, translation):
    return {
        "raw_orders": raw(
            spark,
            "raw_orders",
            [
                ("o1", "c1", "delivered", "2018-01-01 00:00:00", None, None, None, "2018-01-09 00:00:00"),
                ("o2", "c1", "created", "2018-01-02 00:00:00", None, None, None, "2018-01-09 00:00:00"),
                ("o3", "c2", "canceled", "2018-01-03 00:00:00", None, None, None, "2018-01-09 00:00:00"),
            ],
        ),
        "raw_order_items": raw(
            spark,
            "raw_order_items",
            [
                ("o1", 1, "p1", "s1", "2018-01-05 00:00:00", "10.5", "1.25"),
                ("o1", 2, "p2", "s1", "2018-01-05 00:00:00", "4.5", "0.75"),
                ("o3", 1, "p3", "s2", "2018-01-05 00:00:00", "1.0", "1.0"),
            ],
        ),
        "raw_payments": raw(spark, "raw_payments", [("o1", 1, "credit_card", 3, "17.0"), ("o2", 1, "voucher", 1, "9.0")]),
        "raw_reviews": raw(spark, "raw_reviews", []),
        "raw_products": raw(
            spark,
            "raw_products",
            [
                ("p1", "beleza_saude", 10, 100, 1, "100", "1", "2", "3"),
                ("p2", "sem_traducao", 10, 100, 2, "200", "1", "2", "3"),
                ("p3", None, None, None, None, None, None, None, None),
            ],
        ),
        "raw_product_category_translation": raw(spark, "raw_product_category_translation", translation),
        "raw_customers": raw(spark, "raw_customers", [("c1", "u1", "01037", "sao paulo", "SP"), ("c2", "u2", "20000", "rio", "RJ")]),
        "raw_sellers": raw(spark, "raw_sellers", [("s1", "01037", "campinas", "SP"), ("s2", "20000", "rio", "RJ")]),
    }


def test_fct_orders_keeps_orders_without_items_or_payments(spark):
    m = build_models(_raw_world(spark, [("beleza_saude", "health_beauty")]))
    out = {r.order_id: r for r in m["fct_orders"].collect()}
    assert list(m["fct_orders"].columns) == list(M.FCT_ORDERS_COLUMNS)
    o1 = out["o1"]
    assert (o1.item_count, o1.total_item_value, o1.total_freight_value) == (2, 15.0, 2.0)
    assert (o1.total_paid_amount, o1.payment_installments_count, o1.payment_installment_opted) == (17.0, 3, True)
    o2 = out["o2"]  # payment, no items
    assert o2.item_count is None and o2.total_item_value is None and o2.total_paid_amount == 9.0
    o3 = out["o3"]  # items, no payment: null measures and flag, never 0
    assert o3.total_paid_amount is None and o3.payment_installment_opted is None
    assert o3.credit_card_count is None and o3.distinct_payment_types_count is None


def test_dim_products_translation_fallbacks(spark):
    m = build_models(_raw_world(spark, [("beleza_saude", "health_beauty")]))
    cats = dict(rows(m["dim_products"], "product_id", "product_category_name"))
    assert cats == {"p1": "health_beauty", "p2": "sem_traducao", "p3": None}


def test_dimensions_pass_through_and_zip_is_text(spark):
    m = build_models(_raw_world(spark, []))
    c = m["dim_customers"]
    assert c.columns == ["customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"]
    assert ("c1", "01037") in rows(c, "customer_id", "customer_zip_code_prefix")
    assert m["dim_sellers"].columns == ["seller_id", "seller_city", "seller_state", "seller_zip_code_prefix"]
    assert m["fct_order_items"].columns == ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]


def test_lookup_fanout_guard_blocks_duplicate_lookup(spark):
    dup = [("beleza_saude", "health_beauty"), ("beleza_saude", "beauty")]
    m = build_models(_raw_world(spark, dup))
    with pytest.raises(M.FanOutError):
        guard_lookup_fanout(m["stg_product_category_translation"])
    guard_lookup_fanout(build_models(_raw_world(spark, [("a", "b")]))["stg_product_category_translation"])


def test_building_the_models_hints_no_broadcast(spark):
    m = build_models(_raw_world(spark, [("beleza_saude", "health_beauty"), ("x", "y")]))
    assert dict(rows(m["dim_products"], "product_id", "product_category_name"))["p1"] == "health_beauty"
    assert "broadcast" not in m["dim_products"]._jdf.queryExecution().logical().toString().lower()
