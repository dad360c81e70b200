"""Intermediate models D1-D4: the only grain-changing work.

The two order-grain aggregates (D2, D3) run as partial + final hash
aggregation: each map task collapses its rows to one partial row per order
before the shuffle, so an order holding a third of all rows still shuffles one
row per map task.  Their output is hash-partitioned on ``order_id``, which the
joins of ``fct_orders`` reuse without another exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions.expressions import money_round, surrogate_key

# Fixed value: the payment type whose installments count as real installments.
CARD = "credit_card"


def int_order_items(stg_order_items: DataFrame) -> DataFrame:
    """Line grain, money rounded to cents."""
    return stg_order_items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_at",
        money_round("price").alias("price"),
        money_round("freight_value").alias("freight_value"),
    )


def int_order_items_summary(stg_order_items: DataFrame) -> DataFrame:
    """Per order, count of lines and rounded sums of the *unrounded* staging values."""
    return stg_order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        money_round(F.sum("price")).alias("total_item_value"),
        money_round(F.sum("freight_value")).alias("total_freight_value"),
    )


def int_order_payments(stg_payments: DataFrame, distinct_types: str = "exact") -> DataFrame:
    """D3: per order payment measures.

    * installments are summed over card rows only (else 0), so voucher rows do
      not inflate them and two cards add up (10 + 1 = 11);
    * a null payment type is neither a card nor a distinct type;
    * the flag is three-valued: null when the installment sum is null.

    ``distinct_types="exact"`` (default) uses ``count(distinct)``: Spark plans it
    as a codegen'd hash aggregate on (order, type) partials, two shuffles.
    ``"set"`` uses ``size(collect_set)``: one shuffle, but an object hash
    default.  Both give the same numbers; the type domain is a handful of
    values, so either stays bounded per order.
    """
    is_card = F.col("payment_type") == F.lit(CARD)
    if distinct_types == "set":
        n_types = F.size(F.collect_set("payment_type"))
    elif distinct_types == "exact":
        n_types = F.count_distinct("payment_type")
    else:
        raise ValueError(f"distinct_types must be 'set' or 'exact', not {distinct_types!r}")
    return (
        stg_payments.groupBy("order_id")
        .agg(
            money_round(F.sum("payment_value")).alias("total_paid_amount"),
            F.sum(F.when(is_card, F.col("payment_installments")).otherwise(F.lit(0))).alias(
                "payment_installments_count"
            ),
            F.count(F.when(is_card, F.lit(1))).alias("credit_card_count"),
            n_types.cast("bigint").alias("distinct_payment_types_count"),
        )
        .withColumn("payment_installment_opted", F.col("payment_installments_count") > F.lit(1))
    )


def int_order_reviews(stg_reviews: DataFrame) -> DataFrame:
    """Native (order, review) grain, no dedup, deterministic surrogate key."""
    return stg_reviews.select(
        surrogate_key("order_id", "review_id").alias("order_review_id"),
        "order_id",
        "review_id",
        "review_score",
        "review_created_at",
        "review_answered_at",
    )
