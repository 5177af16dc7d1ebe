"""Connected components of a graph given by its edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import pin



def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these neighbours."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node of the component.

    ``edges`` has the long columns ``a`` and ``b``. Each round links neighbourhoods to their smallest
    node, first among larger, then among smaller neighbours, and is written to the shared folder, so a
    lost executor costs one round at most. Rounds grow with the logarithm of the longest path. Hot
    nodes are added up before the shuffle; their rows are split by AQE in the joins.
    """
    ends = F.when(F.col("a") > F.col("b"), F.struct(F.col("a"), F.col("b"))).otherwise(
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    now = pin(edges.where("a <> b").select(ends.alias("e")).select("e.a", "e.b").distinct(), purpose)
    before = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if mark == before or mark[0] == 0:
            break
        before = mark
        now = pin(_small_star(_large_star(now).distinct()).distinct(), purpose)
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
