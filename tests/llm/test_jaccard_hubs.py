import random

import numpy as np
import pyarrow as pa
import pytest

from cartloom.llm import jaccard
from tests.llm.test_jaccard import brute, corpus


def drawn(seed, groups, near, size):
    """Sets of which each group's members differ from its first in up to ``near`` shingles."""
    draw = np.random.default_rng(seed)
    sets = []
    for _ in range(groups):
        base = draw.integers(0, 2**64, int(draw.integers(1, size)), np.uint64)
        for _ in range(int(draw.integers(1, 12))):
            own, k = base.copy(), int(draw.integers(0, near + 1))
            own[draw.integers(0, len(own), k)] = draw.integers(0, 2**64, k, np.uint64)
            sets.append(np.unique(own[draw.random(len(own)) > 0.02 * draw.integers(0, 3)]))
    return [s for s in sets if len(s)]


def sketches_of(sets, percent):
    return jaccard.Sketches(np.array([len(s) for s in sets]), pa.array([jaccard.sketch(s, percent) for s in sets], pa.binary()), percent)


def roots(n, pairs):
    root = np.arange(n)
    for a, b in pairs:
        root[root == root[a]] = root[b]
    return [int(np.flatnonzero(root == r)[0]) for r in root]


@pytest.mark.parametrize("percent, size, near", [(90, 300, 12), (80, 900, 60), (50, 100, 20), (100, 40, 1)])
def test_sketches_pass_every_linked_pair(percent, size, near):
    sets = drawn(percent, 40, near, size)
    found = sketches_of(sets, percent)
    i, j = np.triu_indices(len(sets), 1)
    overlap = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    sizes = found.sizes[i] + found.sizes[j]
    passed = found.linkable(i, j)
    assert (found.apart(i, j) <= sizes - 2 * overlap).all()
    linked = 100 * overlap >= percent * (sizes - overlap)
    assert linked.any() and passed[linked].all()
    apart = (overlap == 0) & (np.minimum(found.sizes[i], found.sizes[j]) >= 20)
    assert passed[apart].mean() < 0.01


@pytest.mark.parametrize("percent, size, near", [(90, 300, 40), (80, 900, 60), (50, 100, 20)])
def test_forest_ties_what_all_pairs_tie(percent, size, near):
    sets = drawn(7 + percent, 60, near, size)
    found = sketches_of(sets, percent)
    i, j = np.triu_indices(len(sets), 1)
    passed = found.linkable(i, j)
    a, b = map(np.concatenate, found.forest(np.arange(len(sets))))
    want = roots(len(sets), zip(i[passed], j[passed]))
    assert roots(len(sets), zip(a, b)) == want and len(a) == len(sets) - len(set(want))


def test_rows_of_a_hub_come_in_one_piece():
    hubs = sorted(random.Random(3).choices(range(9), k=60))
    rows = pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array([h // 2 for h in hubs], pa.int32())], names=["hub", "low"])
    for step in (1, 7, 60):
        pieces = list(jaccard._whole((rows.slice(k, step) for k in range(0, 60, step)), ["hub", "low"]))
        assert [x for p in pieces for x in p.column("hub").to_pylist()] == hubs
        held = [set(p.column("hub").to_pylist()) for p in pieces]
        assert sum(map(len, held)) == len(set(hubs))


def seen_by_cells(monkeypatch):
    """Rows of the neighbourhoods that are judged in cells."""
    seen, own = [], jaccard._trees

    def trees(docs, members, *rest):
        seen.extend(members.collect())
        return own(docs, members, *rest)

    monkeypatch.setattr(jaccard, "_trees", trees)
    return seen


def test_chains_of_shared_passages_are_no_neighbourhood(spark, monkeypatch):
    """Every shingle of these texts is in others as well, and none links: no set may be sent for that."""
    monkeypatch.setattr(jaccard, "CELL_CLASSES", 10)
    seen = seen_by_cells(monkeypatch)
    draw = random.Random(5)
    passages = [[f"w{draw.randrange(10**9)}" for _ in range(30)] for _ in range(300)]
    docs = [(i, " ".join(sum((passages[(i + k) % 300] for k in range(3)), []))) for i in range(300)]
    docs += [(1000 + i, docs[i][1] + " end") for i in range(0, 300, 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = sorted(map(tuple, jaccard.linked(df, 3, 90).collect()), key=str)
    assert got == brute(docs, 3, 90) and len({c for _, _, c in got}) == 300
    assert len(seen) == 12 and len({r["hood"] for r in seen}) == 6


@pytest.mark.parametrize("rows, size", [(3, 1 << 24), (1 << 16, 200)])
def test_split_hubs_against_brute_force(spark, monkeypatch, rows, size):
    monkeypatch.setattr(jaccard, "HUB_ROWS", rows)
    monkeypatch.setattr(jaccard, "HUB_BYTES", size)
    docs = corpus(rows % 1000 + size % 1000, 40, 6)
    docs += [(3, docs[5][1]), (907, docs[7][1]), (907, docs[8][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert sorted(map(tuple, jaccard.linked(df, 3, 90).collect()), key=str) == brute(docs, 3, 90)


def test_large_groups_send_each_set_a_few_times(spark, monkeypatch):
    """Near copies of one text: most are tied by sets compared once; only what stays apart meets all others."""
    monkeypatch.setattr(jaccard, "CELL_CLASSES", 10)
    monkeypatch.setattr(jaccard, "CHILDREN", 50)
    sent, own = [], jaccard._judged

    def judged(docs, placed, *rest):
        sent.extend(r["cells"] for r in placed.collect())
        return own(docs, placed, *rest)

    monkeypatch.setattr(jaccard, "_judged", judged)
    draw = random.Random(6)
    base, docs = [f"w{i}" for i in range(200)], []
    for i in range(600):
        words = list(base)
        for _ in range(draw.randint(0, 5)):
            words[draw.randrange(200)] = f"x{draw.random()}"
        docs.append((i, " ".join(words)))
    docs += [(7, docs[8][1] + " end"), (7, docs[9][1]), (900, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert sorted(map(tuple, jaccard.linked(df, 3, 90).collect()), key=str) == brute(docs, 3, 90)
    assert sum(sent) < 600 * 60 / 4, (sum(sent), len(sent))  # all pairs of 60 parts before


@pytest.mark.parametrize("percent, size, near", [(90, 300, 40), (80, 600, 60)])
def test_finer_sketches_tie_less_and_lose_nothing(percent, size, near):
    sets = drawn(11 + percent, 60, near, size)
    fine = jaccard.Sketches(np.array([len(s) for s in sets]), pa.array([jaccard.sketch(s, percent, 16) for s in sets], pa.binary()), percent, 16)
    i, j = np.triu_indices(len(sets), 1)
    overlap = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    linked = 100 * overlap >= percent * (fine.sizes[i] + fine.sizes[j] - overlap)
    passed = fine.linkable(i, j)
    assert passed[linked].all() and passed.sum() <= sketches_of(sets, percent).linkable(i, j).sum()
    a, b = map(np.concatenate, fine.forest(np.arange(len(sets))))
    assert roots(len(sets), zip(a, b)) == roots(len(sets), zip(i[passed], j[passed]))
    assert len(set(b.tolist())) == len(b)  # one parent each
