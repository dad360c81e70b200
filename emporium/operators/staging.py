"""Staging models C1-C8: cast and rename, one output row per raw row.

Each is a single projection, so Catalyst folds it into the scan: only the
columns a downstream plan uses are read.  Casts use Spark's ANSI mode, so a
malformed timestamp or number fails the job instead of becoming null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ts(c: str) -> Column:
    # Timestamps in the source carry no zone: TIMESTAMP_NTZ, not Spark's zoned TIMESTAMP.
    return F.col(c).cast("timestamp_ntz")


def _dbl(c: str) -> Column:
    return F.col(c).cast("double")


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        _ts("order_purchase_timestamp").alias("order_purchase_at"),
        _ts("order_approved_at").alias("order_approved_at"),
        _ts("order_delivered_carrier_date").alias("order_delivered_carrier_at"),
        _ts("order_delivered_customer_date").alias("order_delivered_customer_at"),
        _ts("order_estimated_delivery_date").alias("order_estimated_delivery_at"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        _ts("shipping_limit_date").alias("shipping_limit_at"),
        _dbl("price").alias("price"),
        _dbl("freight_value").alias("freight_value"),
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        _dbl("payment_value").alias("payment_value"),
    )


def stg_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        _ts("review_creation_date").alias("review_created_at"),
        _ts("review_answer_timestamp").alias("review_answered_at"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        "product_category_name",
        "product_photos_qty",
        _dbl("product_weight_g").alias("product_weight_g"),
        _dbl("product_length_cm").alias("product_length_cm"),
        _dbl("product_height_cm").alias("product_height_cm"),
        _dbl("product_width_cm").alias("product_width_cm"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def stg_product_category_translation(raw: DataFrame) -> DataFrame:
    return raw.select("product_category_name", "product_category_name_english")


# model name -> (raw table, function)
STAGING = {
    "stg_orders": ("raw_orders", stg_orders),
    "stg_customers": ("raw_customers", stg_customers),
    "stg_order_items": ("raw_order_items", stg_order_items),
    "stg_payments": ("raw_payments", stg_payments),
    "stg_reviews": ("raw_reviews", stg_reviews),
    "stg_products": ("raw_products", stg_products),
    "stg_sellers": ("raw_sellers", stg_sellers),
    "stg_product_category_translation": (
        "raw_product_category_translation",
        stg_product_category_translation,
    ),
}
