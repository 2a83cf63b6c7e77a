import random

import pytest

from cartloom.operators import hierarchy


def brute(edges):
    """{id: (parent, path, position, cycle)} by walking up from every node."""
    parent = dict(edges)

    def up(x):
        walked = [x]
        while parent.get(walked[-1]) is not None and parent[walked[-1]] in parent and parent[walked[-1]] not in walked:
            walked.append(parent[walked[-1]])
        last = parent.get(walked[-1])
        return walked, walked[walked.index(last) :] if last in walked else None

    found = {}
    for x in parent:
        walked, ring = up(x)
        if ring is None:
            found[x] = (parent[x], walked[::-1], len(walked), None)
            continue
        upwards, _ = up(min(ring))
        cycle = [min(ring), *upwards[:0:-1]]
        path = cycle[: cycle.index(x) + 1] if x in ring else None
        found[x] = (parent[x], path, len(path) if path else None, cycle)
    return found


def paths_of(spark, edges, kind="bigint", **options):
    df = spark.createDataFrame(edges, f"id {kind}, parent_id {kind}").repartition(3)
    return {r.id: (r.parent_id, r.path, r.position, r.cycle) for r in hierarchy.paths(df, **options).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    """Trees, loops with tails and trees below them, parents that don't exist, self-loops."""
    draw = random.Random(seed)
    edges = []
    for i in range(150):
        chance = draw.random()
        parent = None if chance < 0.03 else 9_000 + i if chance < 0.06 else i if chance < 0.07 else draw.randrange(150) if chance < 0.8 else draw.randrange(max(1, i))
        edges.append((i, parent))
    want = brute(edges)
    assert sum(v[3] is not None for v in want.values()) > 10 and any(v[3] and v[1] is None for v in want.values())
    assert paths_of(spark, edges) == want
    if seed == 1:  # salted joins and text ids
        assert paths_of(spark, edges, task_rows=20) == want
        named = [(f"n{i:03d}", None if p is None else f"n{p:03d}") for i, p in edges]
        assert paths_of(spark, named, "string") == brute(named)


def test_rounds_follow_the_logarithm(spark, monkeypatch):
    rounds = []
    real = hierarchy._joined_up
    cut = hierarchy.cut_lineage

    def counted(steps, task_rows):
        before = len(cuts)
        done = real(steps, task_rows)
        rounds.append(len(cuts) - before - 1)
        return done

    cuts = []
    monkeypatch.setattr(hierarchy, "cut_lineage", lambda df: cuts.append(1) or cut(df))
    monkeypatch.setattr(hierarchy, "_joined_up", counted)
    chain = [(i, i - 1 if i else None) for i in range(600)]
    assert paths_of(spark, chain)[599] == (598, list(range(600)), 600, None)
    assert rounds == [10]
    ring = [(i, (i + 1) % 100) for i in range(100)] + [(100 + i, 99 + i) for i in range(60)]
    assert paths_of(spark, ring) == brute(ring)
    assert rounds[1] <= 1 and rounds[2] <= 8


def test_only_leaves_only_loops_and_nothing(spark):
    assert paths_of(spark, [(1, None), (2, 7)]) == {1: (None, [1], 1, None), 2: (7, [2], 1, None)}
    assert paths_of(spark, [(3, 3), (5, 4), (4, 5)]) == {3: (3, [3], 1, [3]), 4: (5, [4], 1, [4, 5]), 5: (4, [4, 5], 2, [4, 5])}
    assert paths_of(spark, []) == {}
