"""Connected components of an edge table by alternating star operations.

Each round points every node's neighbours at its smallest neighbour, first the
larger ones, then the smaller ones; the graph becomes a forest of stars in a
logarithmic number of rounds.  Minima are aggregated before the shuffle and
neighbours are joined, never collected, so a node with very many links is
split like any skewed join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import drop_scratch, stored


def _stars(edges: DataFrame) -> DataFrame:
    """Large star, then small star, on edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "stars")
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    large = stored(large, "stars")
    least2 = stored(large.groupBy("u").agg(F.min("v").alias("m")), "stars")
    small = large.join(least2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = stored(small.unionByName(least2.select("u", F.col("m").alias("v"))).distinct(), "stars")
    drop_scratch(edges.sparkSession, least, large, least2)
    return out


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of its component, for each node that
    has a smaller one linked to it; other nodes are their own label.  ``edges``
    are (u, v) in either order; no edges give an empty table."""
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now = stored(pairs, "stars")
    state = _state(now)
    while state[0]:
        after = _stars(now)
        drop_scratch(edges.sparkSession, now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
