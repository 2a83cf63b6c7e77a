import random

import pytest

from cartloom.contract.model import Column, Contract, Reference, Table
from cartloom.operators import closure, mutate


def brute(edges, marked, direction):
    found, more = set(marked), True
    while more:
        new = {a for a, b in edges if b in found} if direction == closure.BACKWARDS else {b for a, b in edges if a in found}
        more = not new <= found
        found |= new
    return found


def frames(spark, edges, marked):
    return (spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in edges], "a string, b string").repartition(3),
            spark.createDataFrame([(f"n{x}",) for x in marked], "node string"))


@pytest.mark.parametrize("direction", [closure.BACKWARDS, closure.FORWARDS])
def test_marks_reach_what_they_should(spark, direction):
    """Chains, loops, several references a row, and a row that many refer to."""
    draw = random.Random(3)
    edges = [(i, i - 1) for i in range(1, 60)] + [(100, 101), (101, 102), (102, 100), (103, 100), (104, 104), (105, 104)]
    edges += [(a, draw.randrange(200, a)) for a in range(201, 260) for _ in range(draw.choice([1, 1, 2, 3]))] + [(300 + i, 5) for i in range(80)]
    marked = [3, 30, 102, 104, 220, 240, 400]
    got = closure.spread(*frames(spark, edges, marked), direction)
    assert {r.node for r in got.collect()} == {f"n{x}" for x in brute(edges, marked, direction)}


def test_nothing_to_spread(spark):
    assert closure.spread(*frames(spark, [], [1]), closure.FORWARDS).count() == 1
    assert closure.spread(*frames(spark, [(1, 2)], []), closure.FORWARDS).isEmpty()


NODES = Table("nodes", (Column("id", "bigint"), Column("parent", "bigint", nullable=True)), primary_key=("id",), references=(Reference("parent", "nodes", "id"),))


@pytest.fixture
def cuts(monkeypatch):
    """Number of checkpoints of the walk."""
    made, real = [], closure.cut_lineage
    monkeypatch.setattr(closure, "cut_lineage", lambda df: made.append(1) or real(df))
    return made


@pytest.mark.parametrize("broken", [True, False])
def test_a_chain_of_a_thousand_inserts(spark, cuts, broken):
    """Each row refers to the one before; the first one's parent is missing, or there."""
    table = spark.createDataFrame([(0, None)], "id long, parent long")
    changes = spark.range(1, 1001).selectExpr("id", f"if(id = 1, {'-5' if broken else '0'}, id - 1) AS parent", "'insert' AS op")
    done = mutate.batch({"nodes": changes}, Contract((NODES,)), {"nodes": table})["nodes"]
    assert done.table.count() == (1 if broken else 1001)
    assert done.rejected.count() == (1000 if broken else 0)
    assert len(cuts) <= 2 * 10 + 4


def test_a_chain_of_a_thousand_deletes(spark, cuts):
    """Row 1000 is held by a row that stays; the rows above it are its parents, up to the first."""
    table = spark.range(0, 1002).selectExpr("id", "if(id = 0, null, id - 1) AS parent")
    keys = spark.range(0, 1001).select("id")
    done = mutate.delete_batch({"nodes": keys}, Contract((NODES,)), {"nodes": table})["nodes"]
    assert done.table.count() == 1002 and done.rejected.count() == 1001
    assert len(cuts) <= 2 * 10 + 4
    gone = mutate.delete_batch({"nodes": spark.range(400, 1002).select("id")}, Contract((NODES,)), {"nodes": table})["nodes"]
    assert gone.table.count() == 400 and gone.rejected.isEmpty()
