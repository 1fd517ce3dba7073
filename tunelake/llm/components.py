"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.rows import cut


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of edges (a, b) of longs; root is the least node it reaches.

    Two steps alternate until nothing changes: every node hands its larger
    neighbours to its least neighbour, then its smaller ones. Each halves the way to
    the root, so long chains take a number of rounds that grows with their logarithm.
    """
    now = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while (seen := now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()) != mark:
        mark = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("m", F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"))
        now = cut(small.select("u", F.col("m").alias("v")).distinct())
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
