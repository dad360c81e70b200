"""The declared check suite (53 checks over 17 models) and its runner.

Each check folds to one row ``(check_id, model, kind, columns, failures,
passed)``.  ``not_null`` checks of one model share a scan and need no shuffle;
``accepted_values`` counts distinct offending values, which shuffles those
only.  ``unique`` and ``unique_combination`` are one typed aggregate per key,
``relationships`` an anti join of typed key sets.  Models that are projections
of one table have the same aggregate, whose exchange Spark then reuses: the
line-item key of the staging, intermediate and mart layer is shuffled once.
All checks run as one union, and only one row per check reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.operators import checks as C

NOT_NULL, UNIQUE, ACCEPTED, RELATIONSHIPS, COMBINATION = (
    "not_null",
    "unique",
    "accepted_values",
    "relationships",
    "unique_combination",
)


@dataclass(frozen=True)
class Check:
    model: str
    kind: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    to: str | None = None
    field: str | None = None

    @property
    def check_id(self) -> str:
        return "__".join((self.kind, self.model, *self.columns))


# The accepted order statuses of the order fact.
ORDER_STATUSES = (
    "shipped",
    "delivered",
    "created",
    "approved",
    "unavailable",
    "invoiced",
    "processing",
    "canceled",
)


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check(model, NOT_NULL, (c,)) for c in cols]


def _key(model: str, col: str) -> list[Check]:
    return [Check(model, UNIQUE, (col,)), Check(model, NOT_NULL, (col,))]


def _combo(model: str, *cols: str) -> Check:
    return Check(model, COMBINATION, tuple(cols))


def _rel(model: str, col: str, to: str, field: str) -> Check:
    return Check(model, RELATIONSHIPS, (col,), to=to, field=field)


# The declared checks.
SUITE: tuple[Check, ...] = tuple(
    # staging (31)
    _key("stg_orders", "order_id")
    + _nn("stg_orders", "customer_id", "order_status")
    + _key("stg_customers", "customer_id")
    + _nn("stg_customers", "customer_city", "customer_state")
    + _key("stg_products", "product_id")
    + [_combo("stg_payments", "order_id", "payment_sequential")]
    + _nn("stg_payments", "order_id", "payment_sequential", "payment_type", "payment_value")
    + _nn("stg_reviews", "review_id", "order_id", "review_score")
    + _key("stg_sellers", "seller_id")
    + _nn("stg_sellers", "seller_city", "seller_state")
    + [_combo("stg_order_items", "order_id", "order_item_id")]
    + _nn("stg_order_items", "order_id", "order_item_id", "product_id", "seller_id", "price")
    + _key("stg_product_category_translation", "product_category_name")
    + _nn("stg_product_category_translation", "product_category_name_english")
    # intermediate (9)
    + _key("int_order_items_summary", "order_id")
    + _key("int_order_payments", "order_id")
    + _key("int_order_reviews", "order_review_id")
    + [_combo("int_order_items", "order_id", "order_item_id")]
    + _nn("int_order_items", "order_id", "order_item_id")
    # marts (13)
    + [_rel("fct_orders", "customer_id", "dim_customers", "customer_id")]
    + _nn("fct_orders", "order_status")
    + [Check("fct_orders", ACCEPTED, ("order_status",), values=ORDER_STATUSES)]
    + [_combo("fct_order_items", "order_id", "order_item_id")]
    + [_rel("fct_order_items", "product_id", "dim_products", "product_id")]
    + [_rel("fct_order_items", "seller_id", "dim_sellers", "seller_id")]
    + [_rel("fct_order_items", "order_id", "fct_orders", "order_id")]
    + _key("dim_customers", "customer_id")
    + _key("dim_sellers", "seller_id")
    + _key("dim_products", "product_id")
)

def _null_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """not_null checks of one model in one scan: ``(check_id, failures)``."""
    counts = df.agg(*[F.count_if(F.col(ch.columns[0]).isNull()).alias(ch.check_id) for ch in checks])
    return counts.unpivot([], [ch.check_id for ch in checks], "check_id", "failures")


def _one_check(models: Mapping[str, DataFrame], ch: Check) -> DataFrame:
    """Any other check as one row ``(check_id, failures)``."""
    df = models[ch.model]
    if ch.kind == UNIQUE:
        bad = C.unique_violations(df, ch.columns[0])
    elif ch.kind == COMBINATION:
        bad = C.unique_combination_violations(df, ch.columns)
    elif ch.kind == ACCEPTED:
        bad = C.accepted_values_violations(df, ch.columns[0], ch.values)
    else:
        bad = C.relationship_violations(df, ch.columns[0], models[ch.to], ch.field)
    return C.failures(bad, ch.kind).select(F.lit(ch.check_id).alias("check_id"), "failures")


def _lookup(mapping: dict[str, str], key: str, cast: str | None = None):
    """A literal map lookup (no join): value of ``mapping`` at column ``key``."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    k = F.col(key) if cast is None else F.col(key).cast(cast)
    return F.create_map(*pairs)[k]


def run_suite(
    models: Mapping[str, DataFrame],
    suite: Sequence[Check] = SUITE,
    known: Mapping[str, int] | None = None,
) -> DataFrame:
    """All checks as one DataFrame ``(check_id, model, kind, columns, failures, passed)``.

    ``known`` has the failures of checks that were counted before, such as those
    observed while a mart was written; they are reported without a scan.

    ``models`` may be lazy plans or published tables; for production runs,
    pass the published marts so checks read stored tables.  Each branch of the
    union yields one row per check, so only one row per declared check leaves
    the executors.
    """
    known = {ch.check_id: int(known[ch.check_id]) for ch in suite if known and ch.check_id in known}
    by_model: dict[str, list[Check]] = {}
    for ch in suite:
        if ch.kind == NOT_NULL and ch.check_id not in known:
            by_model.setdefault(ch.model, []).append(ch)
    parts = [_null_checks(models[model], checks) for model, checks in by_model.items()]
    parts += [_one_check(models, ch) for ch in suite if ch.kind != NOT_NULL and ch.check_id not in known]
    if known:
        spark = models[suite[0].model].sparkSession
        parts.append(spark.createDataFrame(list(known.items()), "check_id string, failures long"))
    totals = parts[0]
    for p in parts[1:]:
        totals = totals.unionByName(p)
    model = {ch.check_id: ch.model for ch in suite}
    kind = {ch.check_id: ch.kind for ch in suite}
    columns = {ch.check_id: ",".join(ch.columns) for ch in suite}
    return totals.select(
        "check_id",
        _lookup(model, "check_id").alias("model"),
        _lookup(kind, "check_id").alias("kind"),
        _lookup(columns, "check_id").alias("columns"),
        F.col("failures").cast("bigint").alias("failures"),
        (F.col("failures") == 0).alias("passed"),
    )
