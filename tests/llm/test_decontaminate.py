import random
import re

from cartloom.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size):
    windows = set()
    for item_id, text in items:
        words = words_of(text)
        for s in range(max(1, len(words) - size + 1) if words else 0):
            windows.add((item_id, tuple(words[s : s + size])))
    found = []
    for doc_id, text in docs:
        words, hit, ids = words_of(text), set(), set()
        for item_id, window in windows:
            for p in range(len(words) - len(window) + 1):
                if tuple(words[p : p + len(window)]) == window:
                    hit.update(range(p, p + len(window)))
                    ids.update([] if item_id is None else [str(item_id)])
        found.append((doc_id, len(words), len(hit), sorted(ids)))
    return sorted(found, key=str)


def compare(spark, docs, items, size):
    d = spark.createDataFrame([(i, t, "w", 3) for i, t in docs], "doc_id long, text string, word string, start int").repartition(5)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contamination(d, b, size).collect()
    want = brute(docs, items, size)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=str) == want
    kept = dc.clean(d, b, size)
    assert kept.columns == d.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _, hit, _ in want if not hit), key=str)


def test_against_brute_force(spark):
    draw = random.Random(5)
    say = lambda n: " ".join(draw.choice(["a", "b", "C", "Éa", "éa", "x1", "the"]) + draw.choice(["", ",", "\n"]) for _ in range(n))
    docs = [(i, say(draw.randint(0, 60))) for i in range(60)] + [(3, None), (None, say(20)), (4, ""), (5, "A b " * 400), (5, "A b " * 400)]
    items = [(i, say(draw.randint(1, 8))) for i in range(30)] + [(40, None), (41, " ,.!"), (42, "THE the"), (43, "THE the"), (None, "a b c"), (44, "k K")]
    for size in (2, 4):
        compare(spark, docs, items, size)


def test_rounds_over_blocks_of_windows(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 200)
    compare(spark, [(i, f"w{i} w{i + 1} w{i + 2} w{i} w1 w2") for i in range(9)], [(i, f"w{i} w{i + 1}") for i in range(7)], 2)


def test_empty_tables(spark):
    compare(spark, [(1, "a b"), (2, None)], [(1, None)], 3)
    compare(spark, [(1, "a b")], [], 3)
    assert dc.contamination(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    windows = dc.windows_of(spark.createDataFrame([(1, "a b")], "item_id long, text string"), 2)
    plan = dc._hits(docs, dc._prefixes(docs, windows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
