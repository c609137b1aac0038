"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of edges (x, y) of longs; the root is the smallest node.

    Large stars hang a node's larger neighbours on its smallest neighbour, small stars its
    smaller ones and itself. Both keep what is connected connected, and in the end every
    node hangs on its root: a number of rounds that grows with the logarithm of the nodes.
    Minima are combined before the shuffle; a node with many neighbours is an ordinary
    skewed join. Loops are ignored. An empty table gives no rows.
    """
    edges = staged(
        edges.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "edges"
    )
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("of"), F.least("m", "x").alias("m"))
        large = both.join(least, F.col("x") == F.col("of")).filter("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = staged(large.filter("x <> y").distinct(), "large_star")
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        hung = large.join(least.withColumnRenamed("x", "of"), F.col("x") == F.col("of"))
        small = hung.select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(
            least.select("x", F.col("m").alias("y"))
        )
        after = staged(small.filter("x <> y").distinct(), "small_star")
        # Done when every node has one edge, to a node that has none of its own.
        several = after.groupBy("x").count().filter("count > 1")
        chained = after.join(after.select(F.col("x").alias("y")), "y", "left_semi")
        edges = after
        if several.isEmpty() and chained.isEmpty():
            break
    roots = edges.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct()
    return edges.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(roots)
