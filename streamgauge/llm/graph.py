"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamgauge.llm.common import stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours; a partial aggregate, so a node may have many."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for the ends of ``edges`` (``a``, ``b``).

    Alternating star contractions: every node hangs its larger neighbours, then
    itself and its smaller ones, below the smallest of them, until nothing moves.
    Rounds grow with the logarithm of the longest path. Each round is stored, so
    that lineage stays short. No edges give no rows.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least_neighbour(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = large.join(_least_neighbour(large), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m"))
        now = stored(small.filter("u <> v").distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
