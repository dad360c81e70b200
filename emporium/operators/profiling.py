"""Profiling jobs N1-N5.

Each returns a DataFrame; the only row caps are where the cap is the
feature (the top-k report of N5).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.functions.expressions import normalized, null_count
from emporium.session import file_bytes

ALL_COLUMNS = "*"


def null_profile(df: DataFrame, table_name: str) -> DataFrame:
    """Row count and per-column null counts in one scan, long format: a row
    per column that has nulls, and one of column ``*`` with the nulls of all
    columns, which a clean table has too.
    Columns: ``table_name, column_name, null_count, row_count``."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"), *[null_count(c).alias(c) for c in cols])
    agg = agg.withColumn("__all", sum((F.col(c) for c in cols), F.lit(0)).cast("bigint"))
    return (
        agg.unpivot(["__rows"], [*cols, "__all"], "column_name", "null_count")
        .replace("__all", ALL_COLUMNS, "column_name")
        .where((F.col("null_count") > 0) | (F.col("column_name") == ALL_COLUMNS))
        .select(
            F.lit(table_name).alias("table_name"),
            "column_name",
            "null_count",
            F.col("__rows").alias("row_count"),
        )
    )


def null_profiles(tables: Mapping[str, DataFrame]) -> DataFrame:
    """N1 over several tables, stacked."""
    out = None
    for name, df in tables.items():
        p = null_profile(df, name)
        out = p if out is None else out.unionByName(p)
    return out


def key_text(cols: Sequence[str]) -> Column:
    """A key tuple as text: parts in double quotes, quotes and backslashes in
    them escaped, nulls bare, so that different keys never look the same."""

    def part(c: str) -> Column:
        escaped = F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        return F.coalesce(F.concat(F.lit('"'), escaped, F.lit('"')), F.lit("null"))

    return F.concat_ws(",", *map(part, cols))


KEY_BYTES = 16 << 20  # bytes of files a partition of keys: about a million narrow rows


def dealt_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key columns, rows of one key in one partition, in a number of
    partitions that follows the size of the files read.  Keys that hardly repeat
    fill the hash map of a partial aggregation with nearly every row of a split;
    so a task's map holds no more than its share of the keys."""
    size = file_bytes(df)
    return df.select(*keys).repartition(-(-size // KEY_BYTES), *keys) if size else df.select(*keys)


def key_duplicates(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Candidate-key duplicates per table (null keys included).

    ``tables`` maps a table name to (frame, key columns).  Columns:
    ``table_name, key_columns, key_value, n_records``."""
    out = None
    for name, (df, keys) in tables.items():
        d = (
            dealt_by_key(df, keys)
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1)
            .select(
                F.lit(name).alias("table_name"),
                F.lit(",".join(keys)).alias("key_columns"),
                key_text(keys).alias("key_value"),
                "n_records",
            )
        )
        out = d if out is None else out.unionByName(d)
    return out


def casing_variants(columns: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Normalized values (``lower(trim(x))``) spelled in more than one way,
    for each (table name, frame, column).

    Columns: ``table_name, column_name, norm, variants``."""
    out = None
    for table_name, df, column in columns:
        d = (
            df.groupBy(normalized(column).alias("norm"))
            .agg(F.count_distinct(column).alias("variants"))
            .where(F.col("variants") > 1)
            .select(F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"), "norm", "variants")
        )
        out = d if out is None else out.unionByName(d)
    return out


def domains(columns: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Distinct domain of each (table name, frame, column), as text.

    Columns: ``table_name, column_name, value``."""
    out = None
    for table_name, df, column in columns:
        d = df.select(
            F.lit(table_name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.col(column).cast("string").alias("value"),
        ).distinct()
        out = d if out is None else out.unionByName(d)
    return out


def shared_ids(
    df: DataFrame,
    id_col: str,
    tie_break: Sequence[str],
    columns: Sequence[str],
    top: int | None = 20,
) -> DataFrame:
    """Rows whose ``id_col`` value occurs on more than one row (bundled
    reviews), as a top-k report ordered by ``id_col`` then ``tie_break``.

    The repeated ids are found by a partially aggregated group-by and
    applied with a left semi join; the top-k keeps k rows per partition
    before the final merge.  ``top=None`` returns every such row."""
    repeated = (
        df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(id_col)
    )
    rows = df.join(repeated, id_col, "left_semi").select(*columns)
    ordered = rows.orderBy(id_col, *tie_break)
    return ordered.limit(top) if top is not None else ordered


def rows_with_value(df: DataFrame, column: str, value) -> DataFrame:
    """Rows where ``column`` equals a bound parameter.

    The value is passed as a named SQL parameter, never spliced into text."""
    spark = df.sparkSession
    return spark.sql(
        f"SELECT * FROM {{frame}} WHERE `{column}` = :value", args={"value": value}, frame=df
    )


def preview(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """H3/H4: a bounded, ordered sample of a result for display.

    The full result stays a DataFrame; only this display slice is capped,
    and ordering makes it deterministic."""
    ordered = df.orderBy(*order_by) if order_by else df.orderBy(*df.columns)
    return ordered.limit(n)
