"""Null and row counts from Parquet footers against scans."""

from __future__ import annotations

import os
import tempfile

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from emporium.operators.checks import null_counts as scanned_nulls
from emporium.plans import publish as P
from emporium.plans.catalog import QUERIES, models
from emporium.sources import footers


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    """Nulls spread unevenly over several files and row groups, in columns of several types."""
    path = os.path.join(tempfile.mkdtemp(prefix="footers-"), "t.parquet")
    df = spark.range(5000, numPartitions=3).select(
        "id",
        F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") < 40, F.lit(1.5)).alias("number"),
        F.lit(None).cast("timestamp_ntz").alias("never"),
        (F.col("id") > 3).alias("flag"),
    )
    df.write.option("parquet.block.size", 4096).parquet(path)
    return path


def test_counts_equal_a_scan_and_read_no_column(spark, stored):
    df = footers.read_with_footers(spark, stored)
    got = footers.null_counts(df, "t")
    plan = _plan(got)
    assert "PushedAggregation: [COUNT(*), COUNT(id), COUNT(text), COUNT(number), COUNT(never), COUNT(flag)]" in plan
    assert "ReadSchema: struct<count(*):bigint,count(id):bigint" in plan
    scan = spark.read.parquet(stored)
    assert rows(got, "column_name", "null_count") == rows(scanned_nulls(scan, scan.columns))
    assert {r["row_count"] for r in got.collect()} == {5000}


def test_other_readers_stay_as_they_were(spark, stored):
    before = spark.conf.get(footers.V1_SOURCES)
    footers.read_with_footers(spark, stored, "id long, text string")
    assert spark.conf.get(footers.V1_SOURCES) == before
    assert "FileScan parquet" in _plan(spark.read.parquet(stored))


def test_filtered_counts_are_scanned(spark, stored):
    df = footers.read_with_footers(spark, stored).where("id < 100")
    got = {r["column_name"]: r["null_count"] for r in footers.null_counts(df, "t").collect()}
    assert got["number"] == 60 and got["text"] == 15 and got["never"] == 100


def test_empty_table(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="footers-"), "e.parquet")
    spark.range(0).write.parquet(path)
    assert rows(footers.null_counts(footers.read_with_footers(spark, path, "id long"), "e")) == [("e", "id", 0, 0)]


def test_published_marts_by_their_footers(spark):
    out, m = tempfile.mkdtemp(prefix="footers-"), models(spark, SF_SMALL)
    done, _ = P.publish(spark, m, out, blocking=())
    found = P.null_profile(spark, done)
    assert "PushedAggregation" in _plan(found)
    want = []
    for name, df in done.items():
        want += [(name, r["column_name"], r["null_count"], df.count()) for r in scanned_nulls(df, df.columns).collect()]
    assert rows(found) == sorted(want, key=repr)
    assert any(n for _, _, n, _ in want)


def test_registered_query_reads_footers_only(spark):
    plan = _plan(QUERIES["prof_footer_nulls"](spark, SF_SMALL))
    assert plan.count("PushedAggregation: [COUNT(*)") == 8
