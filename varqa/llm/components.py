"""Connected components over an edge table, by randomised contraction, cut at each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

FAN = 16


def tree_edges(members) -> tuple[list[int], list[int]]:
    """Edges that tie sorted members into a FAN-ary tree under the first: no node has more than FAN + 1 of them."""
    return [int(x) for x in members[1:]], [int(members[(i - 1) // FAN]) for i in range(1, len(members))]


def connected_components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for every node of edges (src, dst).

    Each round sends a node over to the one around it (or itself) that a hash of the round puts first and draws the edges
    between those. The order is random, so a constant share of the nodes goes in each round whatever the graph is, and
    the rounds grow with the logarithm of the largest component. Both tables are written to the shared folder every round.
    """
    both = materialize(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "edges")
    nodes = both.select(F.col("src").alias("node")).distinct()
    both, gone = both.where("src <> dst"), []
    while not both.isEmpty():
        turn = F.lit(len(gone))
        near = both.groupBy("src").agg(F.min(F.struct(F.xxhash64(turn, "dst").alias("h"), F.col("dst").alias("to"))).alias("m"))
        to = materialize(near.select("src", F.least("m", F.struct(F.xxhash64(turn, "src").alias("h"), F.col("src").alias("to")))["to"].alias("to")), "labels")
        gone.append(to)
        ends = both.join(to.withColumnRenamed("to", "a"), "src").join(to.select(F.col("src").alias("dst"), F.col("to").alias("b")), "dst")
        both = materialize(ends.where("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct(), "edges")
    if not gone:
        return nodes.select("node", F.col("node").alias("label"))
    root = gone.pop()
    while gone:  # where each round's nodes have gone in the end, from the last round back
        via = gone.pop().select("src", F.col("to").alias("via")).join(root.select(F.col("src").alias("via"), "to"), "via", "left")
        root = materialize(via.select("src", F.coalesce("to", "via").alias("to")), "labels")
    full = materialize(nodes.join(root.withColumnRenamed("src", "node"), "node", "left").select("node", F.coalesce("to", "node").alias("root")), "labels")
    return full.join(full.groupBy("root").agg(F.min("node").alias("label")), "root").select("node", "label")
