"""Row and null counts from Parquet footers.

A Parquet file notes in its footer how many rows and how many nulls per column
each row group holds.  Read through Spark's DataSource V2 with aggregate
push-down, ``count(*)`` and ``count(col)`` are answered from there: a task opens
the footers and reads no column.  So the nulls of a published mart cost the
same whatever its rows hold, at any size.

Only plain counts over stored columns are pushed; a filter, an expression or a
grouping makes Spark scan.  A footer without statistics of a column fails the
query rather than guess.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

V1_SOURCES = "spark.sql.sources.useV1SourceList"
PUSH_DOWN = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def _parquet_by_v2(spark: SparkSession) -> Iterator[None]:
    """Within it, a Parquet reader is resolved as a DataSource V2 table."""
    before = spark.conf.get(V1_SOURCES)
    spark.conf.set(V1_SOURCES, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(V1_SOURCES, before)


def read_with_footers(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The Parquet files at ``path``, as a table whose counts are pushed into the
    footers.  Turns the push-down on for this session, which only concerns
    tables read like this one."""
    spark.conf.set(PUSH_DOWN, "true")
    with _parquet_by_v2(spark):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)


def null_counts(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows ``table_name, column_name, null_count, row_count``, one per column
    (clean ones too).  ``df`` is read by ``read_with_footers``."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *(F.count(c).alias(c) for c in columns))
    held = counts.unpivot(["__rows"], columns, "column_name", "__held")
    # A table without row groups has no footer counts: Spark then reports null for
    # what it declares to be never null; ``greatest`` reads it as the number 0.
    total, filled = (F.greatest(c, F.lit(0).cast("long")) for c in ("__rows", "__held"))
    return held.select(F.lit(name).alias("table_name"), "column_name", (total - filled).alias("null_count"), total.alias("row_count"))


def null_profiles(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping | None = None) -> DataFrame:
    """``null_counts`` of several stored tables (name -> path), stacked."""
    out = None
    for name, path in paths.items():
        one = null_counts(read_with_footers(spark, path, (schemas or {}).get(name)), name)
        out = one if out is None else out.unionByName(one)
    return out
