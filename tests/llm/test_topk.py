import math

import numpy as np

from cartloom.llm import topk


def brute(rows, queries, k):
    whole = lambda v: [math.floor(1024 * float(x)) for x in v]
    good = [(i, whole(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for q, v in {(i, tuple(v)) for i, v in good if queries(i)}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))
        found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def compare(spark, rows, k, queries=lambda i: i % 5 == 0):
    df = spark.createDataFrame([(i, v, "l", 0) for i, v in rows], "vec_id long, embedding array<float>, parts string, score int").repartition(6)
    own = topk.integers(df.drop("parts"), "embedding", 1024)
    got = topk.top_k(own, own.where("vec_id % 5 = 0"), k).collect()
    assert sorted(map(tuple, got)) == brute(rows, queries, k)


def vectors(seed, n, d, spread=1.0):
    return [(i, np.float32(v).tolist()) for i, v in enumerate(np.random.default_rng(seed).normal(0, spread, (n, d)))]


def test_against_brute_force(spark):
    rows = vectors(1, 300, 16)
    rows += [(500, None), (505, []), (510, [None] * 16), (515, [float("nan")] + [1.0] * 15), (520, [float("inf")] * 16), (525, [0.5, -0.25]), (526, [1.0, 1.0]), (None, [1.0] * 16)]
    compare(spark, rows, 10)


def test_ties_and_repeated_rows(spark):
    rows = [(i, [0.5, -0.5, 0.125]) for i in range(200)] + [(i, [0.5, 0.5, 0.0]) for i in range(200, 230)]
    compare(spark, rows + [(7, [0.5, -0.5, 0.125])] * 3 + [(205, [0.5, 0.5, 0.0])], 4)


def test_inexact_products_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROUND_BYTES", 900)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    near = [(i, [3000.0 + i % 3 * 2**-10, 2000.0 - i % 5 * 2**-10, 1000.0]) for i in range(80)]
    compare(spark, near, 6)


def test_fewer_candidates_than_k_and_empty_tables(spark):
    compare(spark, vectors(3, 4, 5), 10)
    compare(spark, [(5, [1.0])], 10)
    compare(spark, [], 10)


def test_large_components(spark, monkeypatch):
    """Finite components whose integers pass 31 bits, sums whose parts pass 63 bits, few products at a time."""
    monkeypatch.setattr(topk, "BLOCK_CELLS", 40)
    draw = np.random.default_rng(9)
    compare(spark, [(i, np.float32([2.2e6 + i % 7, *draw.normal(0, 9e4, 5)]).tolist()) for i in range(120)], 7)
    compare(spark, [(i, np.float32([(-1) ** i * 2.5e6, 2.0**-10 * (i % 5), draw.normal()]).tolist()) for i in range(60)], 5)


def test_parts_that_pass_63_bits_are_summed_whole():
    left = np.array([[2**40, 2**40, 5], [1, 2, 3]])
    right = np.array([[2**40, -(2**40), 7], [3, 2, 1]])
    assert topk._exact(left, right).tolist() == [35, 10]
