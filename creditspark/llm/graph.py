"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = written(least, "least-neighbours")
    return (
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them. Edges come with a > b."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("m")), "least-neighbours")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is the least node reachable.

    Each round replaces the edges by a star forest closer to the answer, in a logarithmic number of
    rounds. Hot nodes are safe: minima are pre-aggregated before the shuffle and written, so that the
    joins back to the edges read two shuffles, whose skewed partitions the adaptive planner splits (it
    leaves a join whole that has an aggregate in the same stage). Rounds are
    written to the shared folder, so no lineage is carried over and a lost executor costs one round.
    Nulls: an edge with a null end is no edge. An empty table has no nodes.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = now
        edges = written(_small_star(_large_star(edges)), "edges")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
