"""Connected components by alternating stars, with DataFrame operations only.

Each round links every node to the least node it can see. Groups enter as minima that combine
map-side, never as lists. The edge table is checkpointed every round, so a lost executor costs
one round at most, and nothing but its count and checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.session import materialize


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` of every node that has an edge to another; the root is the least node.

    Roots are listed with themselves. Loops, repeated edges and nulls are ignored. Without edges the result is empty.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = materialize(pairs.filter("u <> v").distinct())
    seen = None
    while True:
        sign = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if sign[0] == 0 or sign == seen:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        seen = sign
        # Large star: every neighbour above a node is linked to the least it can see.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: the smaller neighbours of a node, and the node, go to the least of them.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct())
