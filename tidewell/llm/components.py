"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.session import checkpoint_root


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links to (node, root), root being the smallest node of the component; nodes
    without a link do not occur.  Loops are ignored, null ends are dropped.

    Every round is written to the shared checkpoint folder, so no round is computed twice
    and a lost executor costs one round at most.  The number of rounds grows with the
    logarithm of the longest path.
    """
    checkpoint_root(edges.sparkSession)
    e = edges.select("a", "b").where("a <> b").distinct().checkpoint()
    seen = None
    while True:
        e = _small_star(_large_star(e)).checkpoint()
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == (state["n"], state["h"]):
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = (state["n"], state["h"])
