"""Connected components of an edge table, by alternating large and small stars.

Each pass is two aggregations and two joins on the edge table; a hub's edges are combined map-side (minimum
neighbour) and a skewed join side is left to adaptive execution. Passes are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.session import write_and_read


def stars(edges: DataFrame, most_passes: int = 100) -> DataFrame:
    """(node, root): every node with an edge to another, and the smallest node of its component.

    ``edges``: (a, b) in any order, loops allowed. Roots themselves are not listed.
    """
    now = write_and_read(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(most_passes):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
        # large star: neighbours above u join u's least neighbour
        large = (both.where("v > u").join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.where("m < _u").select(F.col("_u").alias("u"), F.col("m").alias("v"))).distinct())
        large = write_and_read(large, "large-star")
        # small star: u and its smaller neighbours join the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), "m")
        small = (large.join(low, F.col("u") == F.col("_u")).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select(F.col("_u").alias("u"), F.col("m").alias("v"))).distinct())
        now = write_and_read(small, "small-star")
        # done when every node has one edge, and that to a node without an edge of its own
        many = now.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if many.isEmpty() and now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
