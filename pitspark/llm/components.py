"""Connected components by alternating stars, written to shared storage after every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitspark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """edges: long columns a, b.  Returns (node, root) for every node of an edge; root is the least node of its component.

    Each round hangs the neighbours of a node on the least of them, first the larger ones, then the smaller ones, until
    nothing moves.  A node's minimum is an aggregate with map-side combine, so a hub of any size is no group in memory.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", large=False)
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(nearest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(nearest.select("u", F.col("m").alias("v"))).distinct(), "stars", large=False)
        new = tuple(now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if new == mark:
            break
        mark = new
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
