"""Oracle SQL per registered key (DuckDB dialect).

Plain SQL, written the way an analyst would check each result by hand.  Every
list of tables, columns, keys and checks is written out here from the survey of
what is to be computed (its sections K, M and N), so that a table or check the
plans forget shows up as a difference.
"""

from __future__ import annotations

from emporium.plans.oracle_sql import model_sql, sql

# Registered model keys and the models behind them.
MODELS = """
stg_orders stg_customers stg_order_items stg_payments stg_reviews stg_products stg_sellers
int_order_items int_order_items_summary int_order_payments int_order_reviews
dim_customers dim_sellers dim_products fct_order_items fct_orders
""".split()

ORACLE: dict[str, str] = {model: model_sql(model) for model in MODELS}
ORACLE["stg_category_translation"] = model_sql("stg_product_category_translation")

# Columns of the raw tables and of the order fact.
COLUMNS = {
    "raw_orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
    "raw_customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "raw_order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "raw_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "raw_reviews": "review_id order_id review_score review_comment_title review_comment_message review_creation_date review_answer_timestamp",
    "raw_products": "product_id product_category_name product_name_lenght product_description_lenght product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm",
    "raw_sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "raw_product_category_translation": "product_category_name product_category_name_english",
    "fct_orders": (
        "order_id customer_id order_status order_purchase_at order_approved_at order_delivered_carrier_at order_delivered_customer_at order_estimated_delivery_at "
        "item_count total_item_value total_freight_value total_paid_amount payment_installments_count credit_card_count payment_installment_opted distinct_payment_types_count"
    ),
}


def union(parts) -> str:
    return " UNION ALL ".join(parts)


def close(a: str, b: str, tol: float = 0.01) -> str:
    return f"(abs(({a}) - ({b})) <= greatest(1e-9 * greatest(abs({a}), abs({b})), {tol}))"


# ---- checks -----------------------------------------------------------------

ORACLE["chk_unique"] = sql("SELECT review_id, count(*) AS n_records FROM stg_reviews WHERE review_id IS NOT NULL GROUP BY review_id HAVING count(*) > 1")
ORACLE["chk_failures_preview"] = sql("SELECT review_id, count(*) AS n_records FROM stg_reviews WHERE review_id IS NOT NULL GROUP BY review_id HAVING count(*) > 1 ORDER BY review_id LIMIT 10")
ORACLE["chk_not_null"] = sql("SELECT * FROM fct_orders WHERE total_paid_amount IS NULL")
ORACLE["chk_not_null_fused"] = sql(union(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM fct_orders" for c in COLUMNS["fct_orders"].split()))
ORACLE["chk_accepted_values"] = "SELECT event_type, count(*) AS n_records FROM events WHERE event_type NOT IN ('view', 'signup', 'click', 'purchase') GROUP BY event_type"
ORACLE["chk_relationships"] = "SELECT doc_id, count(*) AS n_records FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) GROUP BY doc_id"
ORACLE["chk_unique_combination"] = sql("SELECT order_id, order_item_id, count(*) AS n_records FROM stg_order_items GROUP BY ALL HAVING count(*) > 1")
ORACLE["chk_negative_payments"] = "SELECT c_custkey AS order_id, c_acctbal AS total_paid_amount FROM customer WHERE c_acctbal < 0"
ORACLE["chk_lookup_fanout"] = "SELECT p_type, count(*) AS n FROM part GROUP BY p_type HAVING count(*) > 1"

ORACLE["chk_orphaned_order_items"] = sql(
    """
    SELECT 'fct_orders' AS input, order_id, order_item_id FROM fct_order_items lines
    WHERE NOT EXISTS (SELECT 1 FROM fct_orders known WHERE known.order_id = lines.order_id)
    UNION ALL
    SELECT 'without_pending' AS input, order_id, order_item_id FROM fct_order_items lines
    WHERE NOT EXISTS (SELECT 1 FROM fct_orders known WHERE known.order_id = lines.order_id AND known.order_status <> 'P')
    """
)
ORACLE["rec_orphans_independent"] = sql(
    """
    SELECT 'fct_orders' AS input, order_id, order_item_id FROM fct_order_items
    WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM fct_orders WHERE order_id IS NOT NULL)
    UNION ALL
    SELECT 'without_pending' AS input, order_id, order_item_id FROM fct_order_items
    WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM fct_orders WHERE order_id IS NOT NULL AND order_status <> 'P')
    """
)

# ---- reconciliation -----------------------------------------------------------

ORACLE["rec_payments"] = sql(
    f"""
    SELECT order_id, 'amount_mismatch' AS issue, paid AS total_paid_amount, round(again, 2) AS recomputed_total
    FROM (SELECT order_id, paid, coalesce(recomputed, 0.0) AS again FROM perturbed LEFT JOIN recomputed USING (order_id)) AS both_sides
    WHERE NOT {close('paid', 'again')}
    UNION ALL
    SELECT order_id, 'payment_without_order', 0.0, round(coalesce(recomputed, 0.0), 2) FROM recomputed
    WHERE order_id NOT IN (SELECT order_id FROM fct_orders WHERE order_id IS NOT NULL)
    """,
    extra={
        "perturbed": """
            SELECT order_id, coalesce(total_paid_amount, 0.0) + CAST(if(order_status = 'O', 0.02, 0.005) AS DOUBLE) AS paid FROM fct_orders
        """,
        "recomputed": "SELECT order_id, sum(CAST(payment_value AS DOUBLE)) AS recomputed FROM raw_payments WHERE order_id IS NOT NULL GROUP BY order_id",
    },
)

LAYERS = ("raw_order_items", "stg_order_items", "int_order_items", "fct_order_items", "doubled_first_lines")
ORACLE["rec_grain_parity"] = sql(
    """
    SELECT l.*, l.row_count = base.row_count AS row_count_matches, l.distinct_keys = base.distinct_keys AS distinct_keys_match
    FROM layers l, (SELECT * FROM layers WHERE layer_order = 0) base
    """,
    extra={
        "doubled_first_lines": "SELECT order_id, order_item_id FROM fct_order_items UNION ALL SELECT order_id, order_item_id FROM fct_order_items WHERE order_item_id = 1",
        "layers": union(f"SELECT '{t}' AS layer, {i} AS layer_order, count(*) AS row_count, count(DISTINCT (order_id, order_item_id)) AS distinct_keys FROM {t}" for i, t in enumerate(LAYERS)),
    },
)

MART_SOURCES = {"dim_customers": ("stg_customers", "customer_id"), "dim_sellers": ("stg_sellers", "seller_id"), "dim_products": ("stg_products", "product_id"), "fct_orders": ("stg_orders", "order_id")}
ORACLE["rec_mart_parity"] = sql(
    "SELECT mart, mart_rows, source_keys, mart_rows = source_keys AS ok FROM ("
    + union(f"SELECT '{mart}' AS mart, (SELECT count(*) FROM {mart}) AS mart_rows, (SELECT count(DISTINCT {key}) FROM {src}) AS source_keys" for mart, (src, key) in MART_SOURCES.items())
    + ") AS parity"
)

ITEM = ("item_count", "total_item_value", "total_freight_value")
PAYMENT = ("total_paid_amount", "payment_installments_count", "credit_card_count", "payment_installment_opted", "distinct_payment_types_count")


def _propagation(label: str, fact: str) -> str:
    same = lambda cols, other: " AND ".join(f"f.{c} IS NOT DISTINCT FROM {other}.{c}" for c in cols)
    return f"""
    SELECT '{label}' AS input, count(*) AS orders_checked, count(*) - count(*) FILTER (WHERE {same(ITEM, 'i')}) AS item_mismatches,
           count(*) - count(*) FILTER (WHERE {same(PAYMENT, 'p')}) AS payment_mismatches,
           bool_and({same(ITEM, 'i')} AND {same(PAYMENT, 'p')}) AS passed
    FROM {fact} f LEFT JOIN int_order_items_summary i USING (order_id) LEFT JOIN int_order_payments p USING (order_id)
    """


ORACLE["rec_measure_propagation"] = sql(
    _propagation("fct_orders", "fct_orders") + " UNION ALL " + _propagation("perturbed", "perturbed"),
    extra={
        "perturbed": """
            SELECT * REPLACE (item_count + CAST(order_status = 'P' AS BIGINT) AS item_count, if(credit_card_count = 2, 3, credit_card_count) AS credit_card_count)
            FROM fct_orders
        """
    },
)
ORACLE["prof_null_totals"] = sql("SELECT order_status, count(*) AS n_orders FROM fct_orders WHERE total_paid_amount IS NULL GROUP BY order_status")


def _prefixes(prefixes, table: str, column: str, match: str) -> str:
    return sql(
        f"""
        SELECT prefix, CASE count(DISTINCT hit) WHEN 0 THEN 'missing' WHEN 1 THEN 'ok' ELSE 'ambiguous' END AS status,
               count(DISTINCT hit) AS n_matches, CASE WHEN count(DISTINCT hit) = 1 THEN min(hit) END AS resolved_id
        FROM wanted LEFT JOIN (SELECT {column} AS hit FROM {table}) AS ids ON {match} GROUP BY prefix
        """,
        extra={"wanted": "SELECT unnest([" + ", ".join(f"'{p}'" for p in prefixes) + "]) AS prefix"},
    )


ORACLE["resolve_id_prefix"] = _prefixes(("Customer#000000012", "Customer#00000012", "Nope"), "stg_customers", "customer_unique_id", "starts_with(hit, prefix)")
ORACLE["resolve_order_prefix"] = _prefixes(("1", "1000", "abC", "-"), "stg_orders", "order_id", "starts_with(lower(hit), lower(prefix))")
ORACLE["prof_order_lookup"] = sql("SELECT * FROM stg_payments WHERE order_id = '1'")

FIELDS = ("total_paid_amount", "payment_installments_count", "credit_card_count", "payment_installment_opted", "distinct_payment_types_count")


def _field_ok(f: str) -> str:
    same = close(f"a.{f}", f"e.{f}") if f == "total_paid_amount" else f"a.{f} = e.{f}"
    return f"(e.{f} IS NULL OR coalesce({same}, FALSE))"


ORACLE["chk_known_orders"] = sql(
    f"""
    SELECT e.order_id, a.order_id IS NOT NULL AS found, {', '.join(f'{_field_ok(f)} AS {f}_ok' for f in FIELDS)},
           a.order_id IS NOT NULL AND {' AND '.join(map(_field_ok, FIELDS))} AS passed
    FROM expected e LEFT JOIN int_order_payments a ON e.order_id = a.order_id
    """,
    extra={
        "expected": """
            SELECT CAST(l_orderkey AS VARCHAR) AS order_id, if(l_orderkey = 2, NULL, sum(l_extendedprice)) AS total_paid_amount,
                   coalesce(sum(l_linenumber) FILTER (WHERE l_returnflag = 'N'), 0) + if(l_orderkey = 4, 1, 0) AS payment_installments_count,
                   count(*) FILTER (WHERE l_returnflag = 'N') AS credit_card_count,
                   coalesce(sum(l_linenumber) FILTER (WHERE l_returnflag = 'N'), 0) > 1 AS payment_installment_opted,
                   if(l_orderkey = 2, NULL, count(DISTINCT l_returnflag)) AS distinct_payment_types_count
            FROM lineitem WHERE l_orderkey <= 5 GROUP BY l_orderkey
            UNION ALL SELECT '-1', 10.0, NULL, NULL, NULL, NULL
        """
    },
)

# ---- the check suite ----------------------------------------------------------

# The declared checks, "model: columns", per kind.
NOT_NULL = """
stg_orders: order_id customer_id order_status
stg_customers: customer_id customer_city customer_state
stg_products: product_id
stg_payments: order_id payment_sequential payment_type payment_value
stg_reviews: review_id order_id review_score
stg_sellers: seller_id seller_city seller_state
stg_order_items: order_id order_item_id product_id seller_id price
stg_product_category_translation: product_category_name product_category_name_english
int_order_items_summary: order_id
int_order_payments: order_id
int_order_reviews: order_review_id
int_order_items: order_id order_item_id
fct_orders: order_status
dim_customers: customer_id
dim_sellers: seller_id
dim_products: product_id
"""
UNIQUE = """
stg_orders: order_id
stg_customers: customer_id
stg_products: product_id
stg_sellers: seller_id
stg_product_category_translation: product_category_name
int_order_items_summary: order_id
int_order_payments: order_id
int_order_reviews: order_review_id
dim_customers: customer_id
dim_sellers: seller_id
dim_products: product_id
"""
COMBINATIONS = {"stg_payments": "order_id, payment_sequential", "stg_order_items": "order_id, order_item_id", "int_order_items": "order_id, order_item_id", "fct_order_items": "order_id, order_item_id"}
REFERENCES = (("fct_orders", "customer_id", "dim_customers"), ("fct_order_items", "product_id", "dim_products"), ("fct_order_items", "seller_id", "dim_sellers"), ("fct_order_items", "order_id", "fct_orders"))
STATUSES = "'shipped', 'delivered', 'created', 'approved', 'unavailable', 'invoiced', 'processing', 'canceled'"


def _declared(text: str):
    for line in text.strip().splitlines():
        model, columns = line.split(": ")
        for column in columns.split():
            yield model, column


def _check(kind: str, model: str, columns: str, failures: str) -> str:
    names = columns.replace(" ", "")
    return f"SELECT '{kind}__{model}__{names.replace(',', '__')}' AS check_id, '{model}' AS model, '{kind}' AS kind, '{names}' AS columns, ({failures}) AS failures"


CHECKS = [_check("not_null", m, c, f"SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {m}") for m, c in _declared(NOT_NULL)]
CHECKS += [_check("unique", m, c, f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) AS d") for m, c in _declared(UNIQUE)]
CHECKS += [_check("unique_combination", m, c, f"SELECT count(*) FROM (SELECT {c} FROM {m} GROUP BY {c} HAVING count(*) > 1) AS d") for m, c in COMBINATIONS.items()]
CHECKS += [_check("relationships", m, c, f"SELECT count(*) FROM {m} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {to} WHERE {c} IS NOT NULL)") for m, c, to in REFERENCES]
CHECKS += [_check("accepted_values", "fct_orders", "order_status", f"SELECT count(DISTINCT order_status) FROM fct_orders WHERE order_status NOT IN ({STATUSES})")]

SUITE = "SELECT *, failures = 0 AS passed FROM (" + union(CHECKS) + ") AS checks"
ORACLE["suite_results"] = sql(SUITE)
ORACLE["suite_summary"] = sql(
    """
    SELECT coalesce(model, '*') AS model, count(*) AS checks, count(*) FILTER (WHERE NOT passed) AS failed_checks, bool_and(passed) AS passed
    FROM suite GROUP BY GROUPING SETS ((model), ())
    """,
    extra={"suite": SUITE},
)

# ---- profiles -------------------------------------------------------------------


def _nulls(table: str) -> str:
    columns = COLUMNS[table].split()
    each = [f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS row_count FROM {table}" for c in columns]
    total = " + ".join(f"count(*) - count({c})" for c in columns)
    return union([f"SELECT * FROM ({union(each)}) AS e WHERE null_count > 0", f"SELECT '{table}', '*', {total}, count(*) FROM {table}"])


ORACLE["prof_null_counts"] = sql(union(map(_nulls, COLUMNS)))

# Columns of the given tables.
GIVEN = {
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "labels": "doc_id quality toxic",
}
ORACLE["prof_footer_nulls"] = union(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS row_count FROM {t}" for t, columns in GIVEN.items() for c in columns.split()
)

KEYS = {
    "raw_orders": "order_id", "raw_products": "product_id", "raw_customers": "customer_id", "raw_payments": "order_id,payment_sequential", "raw_reviews": "review_id",
    "raw_sellers": "seller_id", "raw_order_items": "order_id,order_item_id", "raw_product_category_translation": "product_category_name",
}


def _quoted(column: str) -> str:
    return f"""coalesce('"' || replace(replace(CAST({column} AS VARCHAR), '\\', '\\\\'), '"', '\\"') || '"', 'null')"""


ORACLE["prof_key_duplicates"] = sql(
    union(
        f"SELECT '{t}' AS table_name, '{keys}' AS key_columns, {" || ',' || ".join(map(_quoted, keys.split(',')))} AS key_value, count(*) AS n_records FROM {t} GROUP BY {keys} HAVING count(*) > 1"
        for t, keys in KEYS.items()
    )
)

ORACLE["prof_casing_variants"] = """
SELECT table_name, column_name, lower(trim(city, ' ')) AS norm, count(DISTINCT city) AS variants
FROM (
    SELECT 'customers' AS table_name, 'customer_city' AS column_name,
           CASE WHEN c_nationkey < 8 THEN upper(c_mktsegment) WHEN c_nationkey < 16 THEN lower(c_mktsegment) ELSE c_mktsegment || ' ' END AS city
    FROM customer
    UNION ALL SELECT 'sellers', 'seller_city', if(s_suppkey % 2 = 1, ' ', '') || 'City ' || (s_suppkey % 7) FROM supplier
    UNION ALL SELECT 'raw_sellers', 'seller_city', s_name FROM supplier
) AS cities
GROUP BY ALL HAVING count(DISTINCT city) > 1
"""
DOMAINS = (("raw_customers", "customer_state"), ("raw_payments", "payment_type"), ("raw_reviews", "review_score"))
ORACLE["prof_domain"] = sql(union(f"SELECT DISTINCT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {t}" for t, c in DOMAINS))
ORACLE["prof_shared_review_ids"] = sql(
    """
    SELECT review_id, order_id, review_creation_date
    FROM (SELECT *, count(*) OVER (PARTITION BY review_id) AS n FROM raw_reviews WHERE review_id IS NOT NULL) AS counted
    WHERE n > 1 ORDER BY review_id, order_id LIMIT 20
    """
)
