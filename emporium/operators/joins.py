"""Key-set helpers of the checks and joins; hot keys of bucketed tables.

No broadcast is hinted: Spark broadcasts a side whose measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-plans on the bytes a shuffle
wrote) and otherwise joins by shuffle, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Non-null distinct values of ``key``, as ``name``: partial aggregation
    before the shuffle, so a hot key costs one row per map task."""
    return df.select(F.col(key).alias(name or key)).where(F.col(name or key).isNotNull()).distinct()


def hot_keys(df: DataFrame, key: str, share: int) -> list:
    """Values of ``key`` that more than one row in ``share`` holds (fewer than
    ``share`` values), by heavy-hitter sketches of the partitions, which are
    merged, and an exact count of what they name.

    A sketch of m counters is off by at most 3.5 rows in m; 16 counters for each
    possible hot key leave none out."""
    counters = min(1_000_000, 16 * share)
    sketch = F.expr(f"approx_top_k({key}, {min(2 * share, counters)}, {counters})")
    totals = df.agg(F.count(F.lit(1)).alias("rows"), sketch.alias("top")).select("rows", F.col("top.item").alias("items")).first()
    named = [x for x in totals["items"] or [] if x is not None]
    if not named:
        return []
    some = df.sparkSession.createDataFrame([(x,) for x in named], df.select(key).schema)
    counted = df.join(F.broadcast(some), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n"))  # 2 x share keys at most
    return sorted(r[key] for r in counted.where(F.col("n") * share > totals["rows"]).collect())


def split_hot(df: DataFrame, key: str, hot: list) -> tuple[DataFrame, DataFrame]:
    """Rows of other keys (null ones too), and rows of the ``hot`` ones."""
    some = F.broadcast(df.sparkSession.createDataFrame([(x,) for x in hot], df.select(key).schema))
    return df.join(some, key, "left_anti"), df.join(some, key, "left_semi")


def join_slices(cold: DataFrame, hot: DataFrame | None, other: DataFrame, key: str, how: str) -> DataFrame:
    """``cold`` and ``hot`` (slices of one table, see ``split_hot``) joined with
    ``other`` by ``key``, as if they were one table.

    The cold slice and ``other`` may be bucketed alike and then need no shuffle.
    The hot slice meets only the rows of ``other`` with its few keys, which Spark
    broadcasts by their measured size; so a hot key stays spread over the files
    and tasks it was read by."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join cannot be done slice by slice")
    out = cold.join(other, key, how)
    if hot is None:
        return out
    met = other.join(hot.select(key).distinct(), key, "left_semi")
    return out.unionByName(hot.join(met, key, how))
