"""Connected components of an edge table, without gathering it anywhere.

Alternates large-star and small-star steps until every node points at the
smallest node it can reach.  A step joins edges with one minimum per node, so a
node with very many neighbours is a row of the small side, and its edges can be
split over tasks.  Each round is written to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.durable import durable


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: columns a, b of one orderable type.  Returns node, root: each node
    of an edge and the smallest node it is linked with.  Loops, repeated and
    null edges change nothing; no edges give no rows."""
    current = durable(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )  # always a > b
    while True:
        # Large star: the larger neighbours of each node move to its smallest one.
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(current.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        # Small star: so do the smaller neighbours and the node itself.
        large = large.distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = durable(lowest.select("a", F.col("m").alias("b")).union(moved).distinct())
        # Done once no node is both a child and a parent and each child has one parent.
        tangled = following.join(following.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select(F.lit(1).alias("x"))
        doubled = following.groupBy("a").count().where(F.col("count") > 1).select(F.lit(1).alias("x"))
        current = following
        if tangled.union(doubled).isEmpty():
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(current.select("b", "b").distinct())
