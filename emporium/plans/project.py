"""The model graph: raw -> staging -> intermediate -> marts.

``build_models`` wires the 17 models as lazy DataFrames; building them runs no
job.  ``publish_marts`` writes the five marts as tables (full
overwrite, one after another) after the fan-out guard on the category lookup,
optionally bucketing both facts by ``order_id`` so order-keyed checks later join
them without a shuffle.  ``build_and_test`` publishes them at once, by version
(``plans.publish``).
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from emporium.operators import intermediate as I
from emporium.operators import marts as M
from emporium.operators.staging import STAGING

MARTS = ("dim_customers", "dim_sellers", "dim_products", "fct_order_items", "fct_orders")


class Models(Mapping):
    """Name -> DataFrame, each plan built on first access and memoized."""

    def __init__(self, builders: dict[str, Callable[["Models"], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def build_models(raw: Mapping[str, DataFrame], distinct_types: str = "exact") -> Models:
    """All staging, intermediate and mart models from the eight raw tables."""
    b: dict[str, Callable[[Models], DataFrame]] = {}
    for name, (source, fn) in STAGING.items():
        b[name] = lambda m, source=source, fn=fn: fn(raw[source])
    b["int_order_items"] = lambda m: I.int_order_items(m["stg_order_items"])
    b["int_order_items_summary"] = lambda m: I.int_order_items_summary(m["stg_order_items"])
    b["int_order_payments"] = lambda m: I.int_order_payments(m["stg_payments"], distinct_types)
    b["int_order_reviews"] = lambda m: I.int_order_reviews(m["stg_reviews"])
    b["dim_customers"] = lambda m: M.dim_customers(m["stg_customers"])
    b["dim_sellers"] = lambda m: M.dim_sellers(m["stg_sellers"])
    b["dim_products"] = lambda m: M.dim_products(
        m["stg_products"], m["stg_product_category_translation"]
    )
    b["fct_order_items"] = lambda m: M.fct_order_items(m["int_order_items"])
    b["fct_orders"] = lambda m: M.fct_orders(
        m["stg_orders"], m["int_order_items_summary"], m["int_order_payments"]
    )
    return Models(b)


def guard_lookup_fanout(translation: DataFrame, key: str = "product_category_name") -> None:
    """M5 run before J2: refuse to publish when the lookup key repeats."""
    from emporium.operators.checks import lookup_fanout

    sample = [tuple(r) for r in lookup_fanout(translation, key).limit(10).collect()]
    if sample:
        raise M.FanOutError(f"lookup has duplicate {key} values, e.g. {sample}")


def publish_marts(
    spark: SparkSession,
    models: Mapping[str, DataFrame],
    out_dir: str,
    bucket_facts: int | None = None,
    database: str | None = None,
) -> dict[str, DataFrame]:
    """Write the marts as Parquet tables (full overwrite) and return readers.

    With ``bucket_facts=n`` both facts are written with ``bucketBy(n,
    "order_id")`` as catalog tables of ``database`` (required then, so that no
    table of another database is overwritten), and joins between them on
    ``order_id`` need no exchange.  The rows are dealt by ``order_id`` into n
    partitions first: each bucket is one file, not one per task.  A bucketed
    join cannot be split at runtime, so a table in which one order holds a large
    share of the lines should be published without buckets; AQE then splits it.
    Reading the written tables back cuts the lineage.
    """
    if bucket_facts and not database:
        raise ValueError("bucketed facts are catalog tables: name their database")
    guard_lookup_fanout(models["stg_product_category_translation"])
    published: dict[str, DataFrame] = {}
    for name in MARTS:
        df = models[name]
        path = f"{out_dir.rstrip('/')}/{name}"
        if bucket_facts and name.startswith("fct_"):
            (
                df.repartition(bucket_facts, "order_id")
                .write.mode("overwrite")
                .format("parquet")
                .option("path", path)
                .bucketBy(bucket_facts, "order_id")
                .sortBy("order_id")
                .saveAsTable(f"{database}.{name}")
            )
            published[name] = spark.table(f"{database}.{name}")
        else:
            df.write.mode("overwrite").parquet(path)
            published[name] = spark.read.parquet(path)
    return published


def register_views(models: Mapping[str, DataFrame], names=None) -> list[str]:
    """B1: expose models as temporary views for SQL access (lazy, nothing runs)."""
    registered = []
    for name in names or list(models):
        models[name].createOrReplaceTempView(name)
        registered.append(name)
    return registered


def build_and_test(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out_dir: str,
    bucket_facts: int | None = None,
    database: str | None = None,
    blocking: Collection[str] = (),
):
    """Build every model, publish the marts, then check what was published.

    The marts are published as one version (``plans.publish``): readers see all
    of them or none.  Checks of the marts read the stored tables, but for those
    counted while these were written; checks of staging and intermediate models
    read their lazy plans (views).  ``blocking`` names checks that must pass
    before the commit (none by default: failures are reported).  Returns
    ``(published marts, suite results, payment reconciliation, measure
    propagation)``; the last two compare the stored order fact with the raw
    payments and the intermediate models.
    """
    from emporium.operators.reconcile import measure_propagation, payment_reconciliation
    from emporium.plans.publish import publish

    models = build_models(raw)
    marts, results = publish(spark, models, out_dir, blocking, bucket_facts, database)
    payments = payment_reconciliation(marts["fct_orders"], raw["raw_payments"])
    measures = measure_propagation(marts["fct_orders"], models["int_order_items_summary"], models["int_order_payments"])
    return marts, results.where("kind <> 'assertion'"), payments, measures
