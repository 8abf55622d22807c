"""Connected components of an undirected edge table, by min-label contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component = smallest node reachable.

    Alternates a large-star and a small-star step (each node's larger, then
    smaller neighbours are linked to its smallest neighbour) until no edge
    changes; the number of rounds grows with the logarithm of the longest path.
    Each round is a written table, so lost executors re-read instead of
    recomputing. A hub's neighbours are only ever aggregated (min) or joined,
    never gathered in one row. Empty input: no rows.
    """
    current = materialise(edges.select("a", "b").where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours of a node are linked to the smallest of its neighbourhood
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours of a node are linked to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                              F.col("m").alias("b")).where("a <> b").distinct()
        current, last = materialise(small, "edges"), current
        discard(last)
        state = current.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
