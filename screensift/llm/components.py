"""Connected components of a large edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screensift.llm.frames import materialise


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One contraction: link every neighbour of a node to the node's smallest neighbour.

    ``pairs`` is (u, v) with v a neighbour of u. The large star moves neighbours
    greater than u, the small star u itself and the neighbours not greater than u. The smallest
    neighbour comes from a pre-aggregated groupBy, so a hub costs no more than
    its edges; the join back is an ordinary equi-join that AQE can split.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = pairs.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    moved = joined.where("v < u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    own = least.where("m < u").select("u", F.col("m").alias("v"))
    return moved.union(own)


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) -> (node, root): root is the smallest node reachable from node.

    Only nodes with an edge to another node are returned; loops and NULL ends
    are ignored, an empty edge table gives an empty result. Every round's edge
    set is written to the shared folder, so a lost executor costs one round.
    """
    cur = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, True).distinct()
        cur = materialise(_star(large, False).distinct(), "edges")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                cur.select("v", "v").distinct())
        mark = now
