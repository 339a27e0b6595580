"""Connected components by alternating star contraction, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.session import materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest id reachable.

    ``edges`` has long columns a, b.  Each round hangs every neighbour of a node on
    the smallest id near it (larger neighbours first, then smaller ones); the rounds
    needed grow with the logarithm of the longest path.  Minima are aggregated before
    the shuffle; joins on a hub's id can be split by adaptive execution.  Every round
    is a written table, so lineage stays short and lost executors re-read files.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct())
    for _ in range(max_rounds):
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        e = materialize(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        # settled once no id has two parents and no parent has one
        open_ = e.select("a").groupBy("a").agg(F.count(F.lit(1)).alias("n")).join(
            e.select(F.col("b").alias("a"), F.lit(1).alias("up")).distinct(), "a", "left").where("n > 1 or up = 1")
        if open_.isEmpty():
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError("components did not settle")
