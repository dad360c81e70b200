"""Declared schemas of the raw commerce tables (A1).

Raw tables arrive as CSV.  Every column is declared; schema inference is never
used (it would turn the zip prefix ``01037`` into ``1037``).  Columns that the
staging layer casts are read as strings, exactly as a CSV delivers them, so
that the staging casts do real (ANSI-strict) work.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in cols])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "raw_orders": _schema(
        ("order_id", S),
        ("customer_id", S),
        ("order_status", S),
        ("order_purchase_timestamp", S),
        ("order_approved_at", S),
        ("order_delivered_carrier_date", S),
        ("order_delivered_customer_date", S),
        ("order_estimated_delivery_date", S),
    ),
    "raw_customers": _schema(
        ("customer_id", S),
        ("customer_unique_id", S),
        ("customer_zip_code_prefix", S),
        ("customer_city", S),
        ("customer_state", S),
    ),
    "raw_order_items": _schema(
        ("order_id", S),
        ("order_item_id", I),
        ("product_id", S),
        ("seller_id", S),
        ("shipping_limit_date", S),
        ("price", S),
        ("freight_value", S),
    ),
    "raw_payments": _schema(
        ("order_id", S),
        ("payment_sequential", I),
        ("payment_type", S),
        ("payment_installments", I),
        ("payment_value", S),
    ),
    "raw_reviews": _schema(
        ("review_id", S),
        ("order_id", S),
        ("review_score", I),
        ("review_comment_title", S),
        ("review_comment_message", S),
        ("review_creation_date", S),
        ("review_answer_timestamp", S),
    ),
    # The two misspelt length columns are the source's own names; staging drops them.
    "raw_products": _schema(
        ("product_id", S),
        ("product_category_name", S),
        ("product_name_lenght", I),
        ("product_description_lenght", I),
        ("product_photos_qty", I),
        ("product_weight_g", S),
        ("product_length_cm", S),
        ("product_height_cm", S),
        ("product_width_cm", S),
    ),
    "raw_sellers": _schema(
        ("seller_id", S),
        ("seller_zip_code_prefix", S),
        ("seller_city", S),
        ("seller_state", S),
    ),
    "raw_product_category_translation": _schema(
        ("product_category_name", S),
        ("product_category_name_english", S),
    ),
}

# Raw tables whose text columns may hold quoted newlines; their CSV must be
# read with multiLine=True, which is not splittable, so ingest them once.
MULTILINE_TABLES = frozenset({"raw_reviews"})

RAW_TABLES = tuple(RAW_SCHEMAS)
