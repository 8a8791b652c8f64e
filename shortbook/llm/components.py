"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortbook.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node points to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it point to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    own = down.join(least, "u")
    return (own.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node with an edge (u, v), the component being
    its least node. Each round is written to the shared folder; their number
    grows with the logarithm of the longest path. No node's edges are gathered
    in one row: minima are pre-aggregated and joined back."""
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .filter("u != v").distinct(), name)
    mark = None
    while True:
        now = stored(_small_star(_large_star(now)), name)
        # a fixed point keeps the number of edges and both sums
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            break
        mark = tuple(state)
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(now.select("v", "v").distinct()))
