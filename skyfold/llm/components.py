"""Connected components by alternating large-star and small-star rounds.

Edges live in a distributed table and every round is a handful of joins and
partial aggregations; nothing is gathered on the driver but one convergence
digest. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import cut

#: A node with more than this share of the edges is hot; the 2n ends of n edges
#: leave room for fewer than 2 / HOT_SHARE = 400 such nodes, however many edges.
HOT_SHARE = 1 / 200


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """``n``: the number of edges. The edges of hot nodes (roots of large groups)
    stay where they are and get the node's minimum by broadcast; the others meet
    theirs in a shuffle."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("d"))
    is_hot = F.col("d") > F.lit(n * HOT_SHARE)
    hot = F.broadcast(low.filter(is_hot).select("u", "m"))
    up = both.filter("v > u")
    moved = up.join(hot, "u").select("v", "m").union(
        up.join(hot.select("u"), "u", "left_anti").join(low.filter(~is_hot), "u").select("v", "m"))
    return moved.toDF("u", "v")


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge with two different ends.

    ``root`` is the smallest node of the component. Nodes without such an edge
    (isolated, or self loops only) are not listed; null ends are ignored;
    repeated edges count once.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b")
    cur = cut(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    digest = None
    while True:
        row = cur.agg(F.count(F.lit(1)).alias("n"),
                      F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if row["n"] == 0 or (row["n"], row["x"]) == digest:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        digest = (row["n"], row["x"])
        cur = cut(_small_star(_large_star(cur, row["n"])))
