"""Connected components of a table of links, by alternating star steps.

A large-star step ties every larger neighbour of a node to the node's smallest neighbour; a small-star
step ties a node's smaller neighbours to the smallest of them. Both are a minimum per key, which is
reduced on the map side, and a join. After a number of rounds that grows with the logarithm of the
longest chain, every component is a star around its smallest node. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.session import durable


def _tied_to_least(links: DataFrame) -> DataFrame:
    """(node, other) links -> (other, least): ``least`` is the smallest of the node's others and itself. The
    table of minima has one row per node, so a node with very many links is a skewed join Spark splits."""
    least = durable(links.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("least")))
    return links.join(least, "node").select("node", "other", "least")


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links of long nodes -> (node, root) for every linked node; root is the smallest of its component.

    Links may repeat, stand in either direction or tie a node to itself (which says nothing). Rows with a
    null are ignored. No links give no rows.
    """
    edges = durable(
        links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _tied_to_least(both).filter(F.col("other") > F.col("node"))
        large = large.select(F.col("other").alias("node"), F.col("least").alias("other"))
        large = durable(large.filter(F.col("node") != F.col("other")).distinct())
        tied = _tied_to_least(large)
        small = tied.select(F.col("other").alias("node"), F.col("least").alias("other")).unionByName(
            tied.select("node", F.col("least").alias("other"))
        )
        after = durable(small.filter(F.col("node") != F.col("other")).distinct())
        # done when every node hangs on one root and no root hangs on another
        done = after.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("node").alias("nodes")).first()
        roots = after.select(F.col("other").alias("node")).distinct()
        if done["n"] == done["nodes"] and after.join(roots, "node", "left_semi").isEmpty():
            break
        edges = after
    own = after.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct()
    return after.select("node", F.col("other").alias("root")).unionByName(own)
