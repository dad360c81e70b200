"""Data-quality checks K1-K5, assertions L1-L2 and the fan-out guard M5.

Every check is ``f(df, ...) -> DataFrame`` of violations: zero rows = pass.
``failures`` counts them the way the check suite does: the violating rows for
``not_null``, the offending values for ``unique``, ``unique_combination`` and
``accepted_values``, and the child rows (the sum of ``n_records``) for
``relationships``.

Scale notes: grouped checks use partial aggregation, so a value holding a
third of all rows shuffles one partial row per map task; key-set comparisons
(relationships, orphans) compare distinct keys, not rows.  Nothing is
collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.operators.joins import distinct_keys

N = "n_records"


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Groups of ``columns`` that occur more than once, null keys included."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(N)).where(F.col(N) > 1)


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """K1 ``unique``: repeated non-null values with their counts.

    Nulls are ignored; ``not_null`` is declared separately wherever needed."""
    return duplicate_groups(df.where(F.col(column).isNotNull()), [column])


def unique_combination_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K5 ``unique_combination_of_columns``: repeated key tuples, nulls kept."""
    return duplicate_groups(df, columns)


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """K2 ``not_null``: the violating rows themselves."""
    return df.where(F.col(column).isNull())


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K2 fused: null count of many columns in one scan, long format
    ``(column_name, null_count)``.  No shuffle: one partial row per task."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def accepted_values_violations(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """K3 ``accepted_values``: non-null values outside the list, with counts."""
    c = F.col(column)
    bad = df.where(c.isNotNull() & ~c.isin(list(values)))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias(N))


def relationship_violations(
    child: DataFrame, column: str, parent: DataFrame, field: str
) -> DataFrame:
    """K4 ``relationships``: non-null child keys missing from ``parent.field``,
    with the number of child rows carrying each.

    The child is pre-aggregated to (key, rows) and the parent to its distinct
    keys before the anti join, so the join shuffles key sets, and both join
    inputs are already partitioned on the key by their aggregates.
    """
    keyed = (
        child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(N))
    )
    return keyed.join(distinct_keys(parent, field, column), column, "left_anti")


def failures(violations: DataFrame, kind: str) -> DataFrame:
    """One row, ``failures``: the count that the suite reports for ``kind``."""
    count = F.coalesce(F.sum(N), F.lit(0)) if kind == "relationships" else F.count(F.lit(1))
    return violations.agg(count.cast("bigint").alias("failures"))


def orphaned_order_items(fct_order_items: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """L1: line-fact rows whose order is not in the order fact.

    One anti join (not left join + ``is null``, which Catalyst keeps as an
    outer join); AQE splits a hot order on the line side.  A null ``order_id``
    is an orphan.  Over facts bucketed by ``order_id`` it needs no shuffle.
    """
    items = fct_order_items.select("order_id", "order_item_id")
    return items.join(fct_orders.select("order_id"), "order_id", "left_anti")


def negative_payment_totals(fct_orders: DataFrame, amount: str = "total_paid_amount") -> DataFrame:
    """L2: orders with a negative payment total (null does not match)."""
    return fct_orders.where(F.col(amount) < 0).select("order_id", amount)


def lookup_fanout(lookup: DataFrame, key: str) -> DataFrame:
    """M5: lookup keys that occur more than once (a left join on them would
    multiply rows).  Columns ``(key, n)``."""
    return (
        lookup.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    )
