"""Mart models D5-D9: three conformed dimensions and two facts.

``fct_orders`` joins order rows to two order-grain aggregates.  Aggregating
before the join keeps the grain (an order with n items and m payments would
otherwise fan out to n*m rows) and lets both joins reuse the aggregates'
hash partitioning on ``order_id``: one exchange per side, one more for the
exact count of distinct payment types, none between an aggregate and its join.  All three sides grow with the data, so none is
broadcast by hint; Spark's size threshold and AQE decide at runtime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class FanOutError(ValueError):
    """The lookup of a left join has duplicate keys and would multiply rows."""


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "customer_zip_code_prefix",
    )


def dim_sellers(stg_sellers: DataFrame) -> DataFrame:
    return stg_sellers.select("seller_id", "seller_city", "seller_state", "seller_zip_code_prefix")


def one_row_per_key(lookup: DataFrame, key: str) -> DataFrame:
    """``lookup`` with one row per non-null ``key``; a repeated key fails when the
    rows are made.  An aggregate by the key, so it needs no job of its own, and a
    hot key is one row per task before the shuffle."""
    others = [c for c in lookup.columns if c != key]
    rows = lookup.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *(F.first(c).alias(c) for c in others))
    said = F.concat(F.lit(f"lookup has several rows of {key} = "), F.col(key).cast("string"))
    once = lambda c: F.when(F.col("_n") > 1, F.raise_error(said)).otherwise(F.col(c)).alias(c)
    return rows.select(key, *map(once, others))


def dim_products(stg_products: DataFrame, stg_translation: DataFrame) -> DataFrame:
    """Products with the English category name where a translation exists.

    The translation is a lookup of tens of rows, which Spark broadcasts by its
    size.  A null category stays null, an untranslated one keeps its name.  A
    category with two translations fails the query that reads the model, instead
    of multiplying products (M5 within the plan).
    """
    t = one_row_per_key(stg_translation, "product_category_name").select(
        F.col("product_category_name").alias("_category"),
        F.col("product_category_name_english").alias("_category_english"),
    )
    p = stg_products
    joined = p.join(t, p["product_category_name"] == t["_category"], "left")
    return joined.select(
        "product_id",
        F.coalesce(F.col("_category_english"), F.col("product_category_name")).alias(
            "product_category_name"
        ),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_photos_qty",
    )


def fct_order_items(int_order_items: DataFrame) -> DataFrame:
    return int_order_items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"
    )


# The column contract of the order fact.
FCT_ORDERS_COLUMNS = (
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_at",
    "order_approved_at",
    "order_delivered_carrier_at",
    "order_delivered_customer_at",
    "order_estimated_delivery_at",
    "item_count",
    "total_item_value",
    "total_freight_value",
    "total_paid_amount",
    "payment_installments_count",
    "credit_card_count",
    "payment_installment_opted",
    "distinct_payment_types_count",
)


def fct_orders(
    stg_orders: DataFrame,
    int_order_items_summary: DataFrame,
    int_order_payments: DataFrame,
) -> DataFrame:
    """Order grain.  Orders without items or payments keep their row with
    null measures (never 0) and a null flag."""
    return (
        stg_orders.join(int_order_items_summary, "order_id", "left")
        .join(int_order_payments, "order_id", "left")
        .select(*FCT_ORDERS_COLUMNS)
    )
