"""Marks that spread along the references between rows.

``edges`` (a, b) lead from a row to a row that it refers to. A mark spreads against them (a row is marked if one it refers
to is) or along them (a row is marked if one that refers to it is). Rows that refer to exactly one other are
walked by pointer doubling: pointers over 1, 2, 4, ... edges are made once, and marks pass over each of them in turn, so a
chain of length d takes about log2(d) rounds. Rows with several references pass their marks by single edges, after
which the pointers are applied again: once more for each layer of such rows on the way, never once for each link.

Pointers are at most one row per node and length; pairs of nodes are never formed, and a node that very many
others refer to is looked up by them with a salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.operators.skew import lookup
from cartloom.session import cut_lineage

BACKWARDS, FORWARDS = "backwards", "forwards"


def _pointers(edges: DataFrame) -> list[DataFrame]:
    """(a, b) over 1, 2, 4, ... edges from nodes with one reference; they end where no node is left, or all go round in loops."""
    single = cut_lineage(edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("b")).where("n = 1").select("a", "b"))
    found, nodes = [], single.count()
    while nodes and (not found or 1 << len(found) <= nodes):
        found.append(single)
        further = single.select(F.col("a").alias("b"), F.col("b").alias("next"))
        single = cut_lineage(lookup(single, further, "b").select("a", F.col("next").alias("b")))
        if single.isEmpty():
            break
    return found


def _passed(marked: DataFrame, edges: DataFrame, direction: str) -> DataFrame:
    """Nodes that get a mark over one step of ``edges``."""
    if direction == BACKWARDS:
        return lookup(edges, marked.select(F.col("node").alias("b"), F.lit(True).alias("m")), "b").select(F.col("a").alias("node")).distinct()
    return lookup(edges, marked.select(F.col("node").alias("a"), F.lit(True).alias("m")), "a").select(F.col("b").alias("node")).distinct()


def spread(edges: DataFrame, marked: DataFrame, direction: str) -> DataFrame:
    """(node): ``marked`` (node) and all nodes that their marks reach over ``edges`` (a, b)."""
    edges = cut_lineage(edges.select("a", "b").distinct())
    marked = cut_lineage(marked.select("node").distinct())
    if edges.isEmpty() or marked.isEmpty():
        return marked
    pointers = _pointers(edges)
    several = cut_lineage(edges.join(pointers[0].select("a"), "a", "left_anti")) if pointers else edges
    more_than_one = not several.isEmpty()
    held = marked.count()
    while True:
        for step in pointers:
            marked = cut_lineage(marked.union(_passed(marked, step, direction)).distinct())
        if not more_than_one:
            return marked
        marked = cut_lineage(marked.union(_passed(marked, several, direction)).distinct())
        before, held = held, marked.count()
        if held == before:
            return marked
