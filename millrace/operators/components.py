"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored


def connected(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node of the pairs (a, b): the smallest node that can be reached from it.

    Every node points to the smallest node it knows. In each round nodes that point to one another's parents hand over the
    smaller of them, and then point past their parent, so paths halve: the rounds grow with the logarithm of the longest
    path. A round is written down before the next. A node with very many neighbours is an aggregate or one side of a join
    that Spark splits, never a group.
    """
    edges = stored(pairs.where("a <> b").select("a", "b").union(pairs.where("a <> b").select("b", "a")).distinct())
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
    roots = stored(roots)
    while True:
        parents = roots.select(F.col("node").alias("b"), F.col("root").alias("beside"))
        # the smallest parent beside each node goes to the node's own parent as well, so that whole trees move
        seen = edges.join(parents, "b").groupBy(F.col("a").alias("node")).agg(F.min("beside").alias("beside"))
        offered = roots.join(seen, "node").select("node", "root", F.least("root", "beside").alias("low"))
        moved = offered.groupBy(F.col("root").alias("node")).agg(F.min("low").alias("moved"))
        lowered = offered.join(moved, "node", "left").select("node", F.col("root").alias("was"), F.least("low", "moved").alias("root"))
        # and past the parent
        above = lowered.select(F.col("node").alias("root"), F.col("root").alias("above"))
        new = stored(lowered.join(above, "root", "left").select("node", F.least("root", "above").alias("root"), "was"))
        roots = new.select("node", "root")
        if new.where("root <> was").isEmpty():
            return roots
