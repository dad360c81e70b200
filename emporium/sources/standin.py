"""Raw-shaped commerce tables derived from the TPC-H-like test tables.

The benchmark data has no commerce CSVs, so each raw table is derived from a
test table with a fixed column mapping.  Every derivation is a narrow
projection (no shuffle) except the category lookup, which is a ``distinct``
over ``part`` (partial aggregation, a handful of output rows).

Every column has the declared raw type of ``emporium.sources.schemas``:
ids and the values the staging layer casts (timestamps, money, sizes) are
text, as a CSV carries them, so the staging casts do real work.

``raw_tables`` returns them as lazy projections, so a query scans the given
files themselves, with column pruning and filter pushdown.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping: payment types stand in for l_returnflag codes,
# and two part types are treated as a missing / an untranslated category.
RETURNFLAG_TO_PAYMENT_TYPE = {"N": "credit_card", "R": "voucher", "A": "boleto"}
MISSING_CATEGORY = "LARGE"
UNTRANSLATED_CATEGORY = "PROMO"

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# The schemas of the given tables that queries read (a declared
# schema keeps Spark from running a job to infer it when a plan is built).
SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    day = _text("o_orderdate")
    not_pending = F.col("o_orderstatus") != F.lit("P")
    return o.select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        day.alias("order_purchase_timestamp"),
        F.when(not_pending, day).alias("order_approved_at"),
        F.when(not_pending, day).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == F.lit("F"), day).alias("order_delivered_customer_date"),
        day.alias("order_estimated_delivery_date"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        _text("l_shipdate").alias("shipping_limit_date"),
        _text("l_extendedprice").alias("price"),
        # whole-unit quantities keep every rounded sum free of half-cent ties
        _text("l_quantity").alias("freight_value"),
    )


def _payment_type(flag: Column) -> Column:
    expr = None
    for code, name in RETURNFLAG_TO_PAYMENT_TYPE.items():
        expr = (F.when if expr is None else expr.when)(flag == F.lit(code), F.lit(name))
    return expr


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        _payment_type(F.col("l_returnflag")).alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        _text("l_extendedprice").alias("payment_value"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    day = _text("o_orderdate")
    return o.select(
        # all orders of one customer share a review id: the bundled-review case
        _text("o_custkey").alias("review_id"),
        _text("o_orderkey").alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        day.alias("review_creation_date"),
        day.alias("review_answer_timestamp"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("double")
    return p.select(
        _text("p_partkey").alias("product_id"),
        F.when(F.col("p_type") != F.lit(MISSING_CATEGORY), F.col("p_type")).alias(
            "product_category_name"
        ),
        F.length("p_name").alias("product_name_lenght"),
        F.lit(None).cast("int").alias("product_description_lenght"),
        F.col("p_size").alias("product_photos_qty"),
        _text("p_retailprice").alias("product_weight_g"),
        _text(size).alias("product_length_cm"),
        _text(size).alias("product_height_cm"),
        _text(size).alias("product_width_cm"),
    )


def raw_product_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return (
        p.select(F.col("p_type").alias("product_category_name"))
        .where(~F.col("product_category_name").isin(MISSING_CATEGORY, UNTRANSLATED_CATEGORY))
        .distinct()
        .select(
            "product_category_name",
            F.lower("product_category_name").alias("product_category_name_english"),
        )
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    nation = _text("c_nationkey")
    return c.select(
        _text("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        nation.alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        nation.alias("customer_state"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    nation = _text("s_nationkey")
    return s.select(
        _text("s_suppkey").alias("seller_id"),
        nation.alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        nation.alias("seller_state"),
    )


BUILDERS = {
    "raw_orders": raw_orders,
    "raw_customers": raw_customers,
    "raw_order_items": raw_order_items,
    "raw_payments": raw_payments,
    "raw_reviews": raw_reviews,
    "raw_products": raw_products,
    "raw_sellers": raw_sellers,
    "raw_product_category_translation": raw_product_category_translation,
}


class RawTables(Mapping):
    """The eight raw tables as lazy projections of the given tables: each is
    built when it is first asked for, and read when a query runs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self._spark, self._sf_dir)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(spark, sf_dir)
