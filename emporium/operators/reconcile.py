"""Cross-layer validation jobs M1-M4, M6-M9 as distributed DataFrame plans.

The reference fetched whole tables into pandas for these; here every job
stays on the executors and returns a result DataFrame whose size is bounded
by the number of problems (or of layers / expectations), never by the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.functions.expressions import has_prefix, is_close, money_round, null_safe_equal

TOLERANCE = 0.01


def payment_reconciliation(
    fct_orders: DataFrame, payments: DataFrame, tolerance: float = TOLERANCE
) -> DataFrame:
    """M1: recompute each order's paid total from raw payments and compare.

    Payment rows with a null order are dropped before grouping; on both sides
    a missing total counts as 0; totals agree when ``isclose(abs_tol=0.01)``.
    One full outer join of the two order-grain sides gives both directions, orders
    whose total disagrees and payments whose order is absent from the fact, so
    neither side is worked out twice.  It reuses the aggregate's partitioning.  A
    full outer join cannot be split at runtime; its sides hold an order once, and
    the only key that may be hot, the null order, matches nothing and goes past it.

    Columns: ``order_id, issue, total_paid_amount, recomputed_total``.
    """
    recomputed = (
        payments.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.sum(F.col("payment_value").cast("double")).alias("_recomputed"))
    )
    fact = fct_orders.select("order_id", "total_paid_amount")
    paid = F.coalesce(F.col("total_paid_amount"), F.lit(0.0))
    again = F.coalesce(F.col("_recomputed"), F.lit(0.0))
    known = fact.where("order_id is not null").withColumn("_in_fact", F.lit(True))
    nameless = fact.where("order_id is null").select("*", F.lit(True).alias("_in_fact"), F.lit(None).cast("double").alias("_recomputed"))
    both = known.join(recomputed, "order_id", "full_outer").unionByName(nameless)
    issue = F.when(F.col("_in_fact").isNull(), "payment_without_order").when(~is_close(paid, again, abs_tol=tolerance), "amount_mismatch")
    # the unrounded sum depends on summation order; expose it in cents
    rows = both.select("order_id", issue.alias("issue"), paid.alias("total_paid_amount"), money_round(again).alias("recomputed_total"))
    return rows.where("issue is not null")


def grain_parity(layers: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """M2: rows and distinct key tuples per layer, against the first layer.

    Counts distinct *row values* ``(a, b)``: a tuple with a null part still
    counts (``count(distinct struct)``, not the null-skipping multi-argument
    form).  ``row_count`` sees fan-out that ``distinct_keys`` cannot.

    Columns: ``layer, layer_order, row_count, distinct_keys, row_count_matches,
    distinct_keys_match``.
    """
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(F.struct(*keys)).alias("distinct_keys"),
        ).select(F.lit(name).alias("layer"), F.lit(i).alias("layer_order"), "*")
        for i, (name, df) in enumerate(layers)
    ]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    # one row per layer: this window sorts len(layers) rows
    base = Window.orderBy("layer_order").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return stacked.select(
        "layer",
        "layer_order",
        "row_count",
        "distinct_keys",
        (F.col("row_count") == F.first("row_count").over(base)).alias("row_count_matches"),
        (F.col("distinct_keys") == F.first("distinct_keys").over(base)).alias("distinct_keys_match"),
    )


def orphans_by_marker(items: DataFrame, orders: DataFrame, key: str = "order_id") -> DataFrame:
    """M3: the orphan check by a plan that shares nothing with L1: left join to
    a marked parent, keep rows whose marker is null (a null key is an orphan too).

    The parent is grouped by key, so the join cannot fan out; a hot key on the
    child side is split by AQE's skew-join handling."""
    marked = orders.groupBy(key).agg(F.max(F.lit(1)).alias("_in_parent"))
    return items.join(marked, key, "left").where("_in_parent is null").drop("_in_parent")


def mart_parity(pairs: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """M4: mart row count vs distinct source keys, one row per mart.

    ``pairs`` = (mart name, mart, source, source key).  Each side is one
    global aggregate; the sides are stacked and folded per mart by a
    group-by over 2 rows per mart (no cross join)."""
    parts = []
    for name, mart, source, key in pairs:
        parts.append(
            mart.agg(F.count(F.lit(1)).alias("v")).select(
                F.lit(name).alias("mart"), F.lit("mart_rows").alias("m"), "v"
            )
        )
        parts.append(
            source.agg(F.count_distinct(key).alias("v")).select(
                F.lit(name).alias("mart"), F.lit("source_keys").alias("m"), "v"
            )
        )
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    folded = stacked.groupBy("mart").agg(
        F.max(F.when(F.col("m") == "mart_rows", F.col("v"))).alias("mart_rows"),
        F.max(F.when(F.col("m") == "source_keys", F.col("v"))).alias("source_keys"),
    )
    return folded.withColumn("ok", F.col("mart_rows") == F.col("source_keys"))


ITEM_MEASURES = ("item_count", "total_item_value", "total_freight_value")
PAYMENT_MEASURES = (
    "total_paid_amount",
    "payment_installments_count",
    "credit_card_count",
    "payment_installment_opted",
    "distinct_payment_types_count",
)


def measure_propagation(
    fct_orders: DataFrame, items_summary: DataFrame, payments: DataFrame
) -> DataFrame:
    """M6: the fact's measures equal the intermediate measures, for all orders.

    Left joins on ``order_id`` (all sides unique per order) and null-safe
    equality per column, so an order without items (null measures on both
    sides) matches.  One summary row:
    ``orders_checked, item_mismatches, payment_mismatches, passed``."""
    f = fct_orders.select("order_id", *ITEM_MEASURES, *PAYMENT_MEASURES)
    i = items_summary.select("order_id", *[F.col(c).alias(f"i_{c}") for c in ITEM_MEASURES])
    p = payments.select("order_id", *[F.col(c).alias(f"p_{c}") for c in PAYMENT_MEASURES])
    joined = f.join(i, "order_id", "left").join(p, "order_id", "left")

    def all_equal(cols, prefix):
        cond = F.lit(True)
        for c in cols:
            cond = cond & null_safe_equal(c, f"{prefix}{c}")
        return cond

    return joined.agg(
        F.count(F.lit(1)).alias("orders_checked"),
        F.count_if(~all_equal(ITEM_MEASURES, "i_")).alias("item_mismatches"),
        F.count_if(~all_equal(PAYMENT_MEASURES, "p_")).alias("payment_mismatches"),
    ).withColumn("passed", (F.col("item_mismatches") == 0) & (F.col("payment_mismatches") == 0))


def null_totals(fct_orders: DataFrame, amount: str = "total_paid_amount") -> DataFrame:
    """M7: orders with a null payment total, counted per status."""
    return (
        fct_orders.where(F.col(amount).isNull())
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


MOST_RANGES = 64  # prefixes that become ranges in one filter


def after_prefix(prefix: str) -> str | None:
    """The least text, by code points, above all texts that begin with ``prefix``;
    None if there is none."""
    for end in range(len(prefix), 0, -1):
        code = ord(prefix[end - 1])
        if code < 0x10FFFF:
            return prefix[: end - 1] + chr(0xE000 if code == 0xD7FF else code + 1)
    return None


def in_prefix_range(column: str, prefix: str) -> Column:
    """``column`` begins with ``prefix``, as a range (null ids are in none)."""
    end = after_prefix(prefix)
    c = F.col(column)
    return (c >= F.lit(prefix)) & (c < F.lit(end)) if end else c >= F.lit(prefix)


def resolve_prefixes(
    ids: DataFrame,
    id_col: str,
    prefixes: Sequence[str],
    case_insensitive: bool = False,
) -> DataFrame:
    """M8: resolve each prefix to exactly one distinct id.

    ``status`` is ``ok`` (one distinct id, given in ``resolved_id``),
    ``missing`` (none) or ``ambiguous`` (several; ``n_matches`` says how many).
    A few case-sensitive prefixes become ranges of ids that are pushed into the
    scan.  Case-insensitive ones, and long lists, are found by an inner equi-join
    on the id's leading characters; the prefix list is the caller's argument and
    Spark broadcasts it by its size.  Only matching ids are aggregated, and the
    result is joined back to the prefixes to report the missing ones.  Prefixes
    are plain text: ``_`` and ``%`` match themselves.
    """
    spark: SparkSession = ids.sparkSession
    prefixes = list(dict.fromkeys(prefixes))
    wanted = spark.createDataFrame([(p,) for p in prefixes], T.StructType([T.StructField("prefix", T.StringType(), False)]))
    ids = ids.select(F.col(id_col).alias("_id"))
    if not case_insensitive and len(prefixes) <= MOST_RANGES:
        # ranges reach the scan, which skips row groups outside of all of them
        within = reduce(Column.__or__, (in_prefix_range("_id", p) for p in prefixes), F.lit(False))
        each = F.array_compact(F.array(*(F.when(F.col("_id").startswith(p), F.lit(p)) for p in prefixes)))
        found = ids.where(within).select("_id", F.explode(each).alias("prefix")) if prefixes else wanted.select(F.col("prefix").alias("_id"), "prefix")
    else:
        # Equi-join on the id's head: one scan emits, per id, its first L
        # characters for each distinct prefix length L (a handful), which are
        # hash-joined to the prefixes.  No nested-loop join, and no wildcard
        # meaning for '_' or '%'.
        fold = F.lower if case_insensitive else (lambda c: c)
        heads = ids.where("_id is not null").select("_id", F.explode(F.array(*[F.substring("_id", 1, n) for n in sorted({len(p) for p in prefixes})])).alias("_head"))
        keyed = wanted.select("prefix", fold(F.col("prefix")).alias("_key"))
        found = heads.join(keyed, fold(F.col("_head")) == F.col("_key")).where(has_prefix("_id", "prefix", case_insensitive))
    hits = found.groupBy("prefix").agg(F.count_distinct("_id").alias("n_matches"), F.min("_id").alias("_any_id"))
    out = wanted.join(hits, "prefix", "left")
    n = F.coalesce(F.col("n_matches"), F.lit(0))
    status = F.when(n == 0, "missing").when(n == 1, "ok").otherwise("ambiguous")
    return out.select(
        "prefix",
        status.alias("status"),
        n.alias("n_matches"),
        F.when(n == 1, F.col("_any_id")).alias("resolved_id"),
    )


PAYMENT_EXPECTATION_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType(), False),
        T.StructField("total_paid_amount", T.DoubleType(), True),
        T.StructField("payment_installments_count", T.LongType(), True),
        T.StructField("credit_card_count", T.LongType(), True),
        T.StructField("payment_installment_opted", T.BooleanType(), True),
        T.StructField("distinct_payment_types_count", T.LongType(), True),
    ]
)
MONEY_FIELDS = frozenset({"total_paid_amount"})


def of_expected_keys(rows: DataFrame, expectations: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows whose key is expected.  Applied before an aggregation by that key,
    it turns the shuffle of a whole table into a filtered scan."""
    return rows.join(expectations.select(key).distinct(), key, "left_semi")


def known_answers(
    actual: DataFrame,
    expectations: DataFrame,
    key: str = "order_id",
    money_fields=MONEY_FIELDS,
) -> DataFrame:
    """M9: compare rows of ``actual`` (unique per key) with expected values.

    A null expectation is not checked.  Money fields compare within 0.01
    (``isclose``), the rest exactly.  An absent key gives ``found = false``
    instead of an error.  One result row per expectation, repeated or not.

    Columns: ``key, found, <field>_ok ..., passed``.
    """
    fields = [c for c in expectations.columns if c != key]
    exp = expectations.select(key, *[F.col(c).alias(f"e_{c}") for c in fields])
    got = actual.select(key, *[F.col(c).alias(f"a_{c}") for c in fields])
    both = exp.join(got.withColumn("_found", F.lit(True)), key, "left")
    found = F.coalesce(F.col("_found"), F.lit(False))
    oks = []
    for c in fields:
        e, a = F.col(f"e_{c}"), F.col(f"a_{c}")
        same = is_close(a, e, abs_tol=TOLERANCE) if c in money_fields else (a == e)
        oks.append(F.when(e.isNull(), F.lit(True)).otherwise(F.coalesce(same, F.lit(False))).alias(f"{c}_ok"))
    passed = F.col("found")
    for c in fields:
        passed = passed & F.col(f"{c}_ok")
    return both.select(key, found.alias("found"), *oks).withColumn("passed", passed)


def suite_summary(results: DataFrame) -> DataFrame:
    """Verdict per model and overall (``model = '*'``).

    Columns: ``model, checks, failed_checks, passed``."""
    per_model = results.groupBy("model").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.bool_and("passed").alias("passed"),
    )
    overall = results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.bool_and("passed").alias("passed"),
    ).select(F.lit("*").alias("model"), "*")
    return per_model.unionByName(overall)
