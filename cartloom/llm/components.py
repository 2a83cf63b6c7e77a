"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    both = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(both, 24)), F.sum(both.bitwiseAND(F.lit((1 << 24) - 1)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long, not null), root the smallest node it can reach.

    Each round hangs the neighbours of every node on the smallest of them, first those above the node, then those below
    it; neighbours are never gathered, only their minimum, which merges before the shuffle. Rounds grow with the
    logarithm of the longest path; each is checkpointed. It ends when every edge leads to a root.
    """
    edges = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut_lineage(large.where("a <> b").distinct())
        below = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(below, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(below.select(F.col("n").alias("a"), F.col("m").alias("b")))
        edges = cut_lineage(small.where("a <> b").distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
