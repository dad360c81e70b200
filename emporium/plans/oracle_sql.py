"""DuckDB SQL for every registered query: the correctness oracle.

Plain SQL over the test tables (``orders``, ``lineitem``, ...); it shares no
list, name or code with the operators.  The stand-in mapping and every model
are CTEs; ``sql(body)`` prefixes a query with the CTEs it needs, in dependency
order.  DuckDB sums integers into HUGEINT, so integer sums are
cast to BIGINT to match Spark.
"""

from __future__ import annotations

import re

# name -> (sql body, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body.strip(), deps)


# ---- stand-in raw tables --------------------------------------------------
_cte(
    "raw_orders",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS order_status,
           CAST(o_orderdate AS VARCHAR) AS order_purchase_timestamp,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS VARCHAR) END AS order_approved_at,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS VARCHAR) END AS order_delivered_carrier_date,
           CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS VARCHAR) END AS order_delivered_customer_date,
           CAST(o_orderdate AS VARCHAR) AS order_estimated_delivery_date
    FROM orders
    """,
)
_cte(
    "raw_order_items",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
           CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id, CAST(l_shipdate AS VARCHAR) AS shipping_limit_date,
           CAST(l_extendedprice AS VARCHAR) AS price, CAST(l_quantity AS VARCHAR) AS freight_value
    FROM lineitem
    """,
)
_cte(
    "raw_payments",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
           CASE l_returnflag WHEN 'N' THEN 'credit_card' WHEN 'R' THEN 'voucher'
                             WHEN 'A' THEN 'boleto' END AS payment_type,
           l_linenumber AS payment_installments,
           CAST(l_extendedprice AS VARCHAR) AS payment_value
    FROM lineitem
    """,
)
_cte(
    "raw_reviews",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score,
           CAST(NULL AS VARCHAR) AS review_comment_title,
           CAST(NULL AS VARCHAR) AS review_comment_message,
           CAST(o_orderdate AS VARCHAR) AS review_creation_date,
           CAST(o_orderdate AS VARCHAR) AS review_answer_timestamp
    FROM orders
    """,
)
_cte(
    "raw_products",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id,
           CASE WHEN p_type <> 'LARGE' THEN p_type END AS product_category_name,
           CAST(length(p_name) AS INTEGER) AS product_name_lenght,
           CAST(NULL AS INTEGER) AS product_description_lenght,
           p_size AS product_photos_qty,
           CAST(p_retailprice AS VARCHAR) AS product_weight_g,
           CAST(CAST(p_size AS DOUBLE) AS VARCHAR) AS product_length_cm,
           CAST(CAST(p_size AS DOUBLE) AS VARCHAR) AS product_height_cm,
           CAST(CAST(p_size AS DOUBLE) AS VARCHAR) AS product_width_cm
    FROM part
    """,
)
_cte(
    "raw_product_category_translation",
    """
    SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
    FROM part WHERE p_type NOT IN ('LARGE', 'PROMO')
    """,
)
_cte(
    "raw_customers",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
           CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
           c_mktsegment AS customer_city, CAST(c_nationkey AS VARCHAR) AS customer_state
    FROM customer
    """,
)
_cte(
    "raw_sellers",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
           s_name AS seller_city, CAST(s_nationkey AS VARCHAR) AS seller_state
    FROM supplier
    """,
)

# ---- staging ----------------------------------------------------------------
_cte(
    "stg_orders",
    """
    SELECT order_id, customer_id, order_status,
           CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_at,
           CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
           CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_at,
           CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_at,
           CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_at
    FROM raw_orders
    """,
    "raw_orders",
)
_cte(
    "stg_customers",
    """
    SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
    FROM raw_customers
    """,
    "raw_customers",
)
_cte(
    "stg_order_items",
    """
    SELECT order_id, order_item_id, product_id, seller_id,
           CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_at,
           CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
    FROM raw_order_items
    """,
    "raw_order_items",
)
_cte(
    "stg_payments",
    """
    SELECT order_id, payment_sequential, payment_type, payment_installments,
           CAST(payment_value AS DOUBLE) AS payment_value
    FROM raw_payments
    """,
    "raw_payments",
)
_cte(
    "stg_reviews",
    """
    SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
           CAST(review_creation_date AS TIMESTAMP) AS review_created_at,
           CAST(review_answer_timestamp AS TIMESTAMP) AS review_answered_at
    FROM raw_reviews
    """,
    "raw_reviews",
)
_cte(
    "stg_products",
    """
    SELECT product_id, product_category_name, product_photos_qty,
           CAST(product_weight_g AS DOUBLE) AS product_weight_g,
           CAST(product_length_cm AS DOUBLE) AS product_length_cm,
           CAST(product_height_cm AS DOUBLE) AS product_height_cm,
           CAST(product_width_cm AS DOUBLE) AS product_width_cm
    FROM raw_products
    """,
    "raw_products",
)
_cte(
    "stg_sellers",
    "SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state FROM raw_sellers",
    "raw_sellers",
)
_cte(
    "stg_product_category_translation",
    """
    SELECT product_category_name, product_category_name_english
    FROM raw_product_category_translation
    """,
    "raw_product_category_translation",
)

# ---- intermediate -----------------------------------------------------------
_cte(
    "int_order_items",
    """
    SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_at,
           round(price, 2) AS price, round(freight_value, 2) AS freight_value
    FROM stg_order_items
    """,
    "stg_order_items",
)
_cte(
    "int_order_items_summary",
    """
    WITH lines AS (
        SELECT order_id, count(*) AS n, sum(price) AS value, sum(freight_value) AS freight
        FROM stg_order_items GROUP BY ALL
    )
    SELECT order_id, n AS item_count, round(value, 2) AS total_item_value, round(freight, 2) AS total_freight_value
    FROM lines
    """,
    "stg_order_items",
)
_cte(
    "int_order_payments",
    """
    SELECT order_id, total_paid_amount, payment_installments_count, credit_card_count, distinct_payment_types_count,
           payment_installments_count >= 2 AS payment_installment_opted
    FROM (
        SELECT order_id, round(sum(amount), 2) AS total_paid_amount,
               CAST(sum(on_card) AS BIGINT) AS payment_installments_count,
               CAST(sum(cards) AS BIGINT) AS credit_card_count,
               count(*) FILTER (WHERE payment_type IS NOT NULL) AS distinct_payment_types_count
        FROM (
            SELECT order_id, payment_type, sum(payment_value) AS amount,
                   coalesce(sum(payment_installments) FILTER (WHERE payment_type = 'credit_card'), 0) AS on_card,
                   count(*) FILTER (WHERE payment_type = 'credit_card') AS cards
            FROM stg_payments GROUP BY order_id, payment_type
        ) AS by_type
        GROUP BY order_id
    ) AS by_order
    """,
    "stg_payments",
)
_cte(
    "int_order_reviews",
    """
    SELECT md5(concat(order_id, '~', review_id)) AS order_review_id, * EXCLUDE (review_comment_title, review_comment_message)
    FROM stg_reviews
    """,
    "stg_reviews",
)

# ---- marts ------------------------------------------------------------------
_cte(
    "dim_customers",
    """
    SELECT customer_id, customer_unique_id, customer_city, customer_state, customer_zip_code_prefix
    FROM stg_customers
    """,
    "stg_customers",
)
_cte(
    "dim_sellers",
    "SELECT seller_id, seller_city, seller_state, seller_zip_code_prefix FROM stg_sellers",
    "stg_sellers",
)
_cte(
    "dim_products",
    """
    SELECT product_id,
           CASE WHEN product_category_name_english IS NULL THEN product_category_name ELSE product_category_name_english END AS product_category_name,
           product_weight_g, product_length_cm, product_height_cm, product_width_cm, product_photos_qty
    FROM stg_products LEFT JOIN stg_product_category_translation USING (product_category_name)
    """,
    "stg_products",
    "stg_product_category_translation",
)
_cte(
    "fct_order_items",
    """
    SELECT order_id, order_item_id, product_id, seller_id, price, freight_value
    FROM int_order_items
    """,
    "int_order_items",
)
_cte(
    "fct_orders",
    """
    SELECT order_id, customer_id, order_status, order_purchase_at, order_approved_at,
           order_delivered_carrier_at, order_delivered_customer_at, order_estimated_delivery_at,
           item_count, total_item_value, total_freight_value, total_paid_amount, payment_installments_count,
           credit_card_count, payment_installment_opted, distinct_payment_types_count
    FROM stg_orders LEFT JOIN int_order_items_summary USING (order_id) LEFT JOIN int_order_payments USING (order_id)
    """,
    "stg_orders",
    "int_order_items_summary",
    "int_order_payments",
)


def _closure(names) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def _referenced(body: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", body))
    return [n for n in CTES if n in words]


def sql(body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <needed CTEs> <body>``; CTE names used in the body are detected.

    ``extra`` adds query-local CTEs (name -> body) after the shared ones; they
    may reference shared CTEs."""
    extra = extra or {}
    needed = _referenced(body)
    for text in extra.values():
        needed += _referenced(text)
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in _closure(needed)]
    parts += [f"{n} AS (\n{text.strip()}\n)" for n, text in extra.items()]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def model_sql(name: str) -> str:
    return sql(f"SELECT * FROM {name}")
