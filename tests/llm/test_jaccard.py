import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cartloom.llm import jaccard
from cartloom.llm.components import components
from cartloom.llm.shingles import shingle_hashes


def sets_of(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([("whole", *words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(docs, size, percent):
    sets, held = [sets_of(t, size) for _, t in docs], defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            held["id", doc_id].append(i)
            for x in sets[i]:
                held[x].append(i)
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (doc_id, _) in enumerate(docs):
        if doc_id is None:
            continue
        for j, k in Counter(j for x in sets[i] for j in held[x] if j > i).items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                parent[find(j)] = find(i)
        for j in held["id", doc_id]:
            parent[find(j)] = find(i)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(sets[i]), least[find(i)] if d is not None else None) for i, (d, _) in enumerate(docs)), key=str)


def corpus(seed, n, edits):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(30)]
    docs = []
    for base in range(n):
        words = passage * (base % 3 == 0) + [word() for _ in range(draw.choice([1, 2, 5, 40, 90]))]
        for _ in range(draw.choice([1, 1, 3, 12])):
            own = list(words)
            for _ in range(draw.randint(0, edits)):
                at = draw.randrange(len(own))
                own[at : at + draw.randint(0, 1)] = [word()]
            docs.append(draw.choice([" ", "\t", "\n "]).join(own) + draw.choice(["", " "]))
    draw.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("size, percent, classes", [(3, 90, 1024), (3, 90, 3), (5, 80, 5), (2, 50, 4), (1, 100, 2)])
def test_against_brute_force(spark, monkeypatch, size, percent, classes):
    monkeypatch.setattr(jaccard, "CELL_CLASSES", classes)
    docs = corpus(size * percent + classes, 40, 6)
    docs += [(900, ""), (901, None), (902, " \t"), (903, "A b"), (904, "a B"), (905, "a b c"), (None, docs[0][1]), (3, docs[5][1]), (906, docs[7][1]), (907, docs[7][1]), (907, docs[7][1])]
    rows = [(i, t, "x", 1) for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, class int").repartition(6)
    got = jaccard.linked(df, size, percent).collect()
    want = brute(docs, size, percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    if classes == 1024:
        kept = jaccard.representatives(df, size, percent)
        assert kept.columns == df.columns
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == staying(docs, size, percent)


def staying(docs, size, percent):
    """Rows of which no text that comes before in (doc_id, digest of the text) is reached by links; each text by itself."""
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest() if t is not None else ""
    texts = sorted({(i, digest(t), t) for i, t in docs if i is not None}, key=lambda x: x[:2])
    found = brute([(n, t) for n, (_, _, t) in enumerate(texts)], size, percent)
    stay = {n for n, _, component in found if n == component}
    return sorted([(i, t) for n, (i, _, t) in enumerate(texts) if n in stay] + [(i, t) for i, t in docs if i is None], key=str)


def test_texts_of_one_id_are_judged_apart(spark):
    """Nothing is lost that nothing duplicates; the choice among equal rows is stated."""
    one, other, third = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, one, 5), (1, other, 4), (2, third, 3), (2, other + " end", 2), (3, one, 1), (3, None, 1), (3, "", 1), (1, one, 2), (None, one, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(4)
    kept = sorted(map(tuple, jaccard.representatives(df, 5, 80).collect()), key=str)
    assert kept == sorted([(1, one, 2), (1, other, 4), (2, third, 3), (3, None, 1), (3, "", 1), (None, one, 0)], key=str)


def test_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL_CLASSES", 100)
    draw = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(700):
        own = list(base)
        for _ in range(draw.randint(0, 7)):
            own[draw.randrange(150)] = f"x{draw.random()}"
        docs.append((i, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert sorted(map(tuple, jaccard.linked(df, 3, 90).collect()), key=str) == brute(docs, 3, 90)


def test_empty_table(spark):
    assert jaccard.linked(spark.createDataFrame([], "doc_id long, text string"), 3, 90).collect() == []


def test_shingles_of_texts_equal_sets():
    texts = ["a b c d", "A  b\tc\nd ", "a b", "ab", "", None, "é x é", "a b c a b c", "b a", "aa b"]
    found = [frozenset(x.tolist()) for x in shingle_hashes(texts, 3)]
    want = [sets_of(t, 3) for t in texts]
    assert [len(x) for x in found] == [len(x) for x in want]
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert len(found[i] & found[j]) == len(want[i] & want[j])


def test_components(spark):
    draw = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    assert got == {x: find(x) for x in parent}
