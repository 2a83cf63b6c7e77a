import random

import numpy as np

from cartloom.llm import line_dedup as ld
from cartloom.llm.cuckoo import CuckooFilter

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def key(line):
    own = line.strip(BLANK).translate(LOWER)
    return own if len(own) >= ld.MIN_CHARS else None


def brute(docs):
    holders = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if key(line) and doc_id is not None:
                holders.setdefault(key(line), set()).add(doc_id)
    found = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or not key(x) or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc_id]
        found.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(found, key=str)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, n_lines string, drop_keys int").repartition(4)


def result(index, docs):
    cleaned = index.clean(docs)
    assert cleaned.columns == ["doc_id", "text", "n_lines", "drop_keys", "n_lines_", "n_dropped_"]
    return sorted(((r.doc_id, r.text or "", r["n_lines_"], r["n_dropped_"]) for r in cleaned.collect()), key=str)


def corpus(seed, ids):
    draw = random.Random(seed)
    lines = [f"a line with number {i % 25}" for i in range(25)] + ["short", "", "  Padded LINE here \t", "padded line here", "né" * 5, "n" * 9, "é" * 9, "\x1c0123456789"]
    return [(i, "\n".join(draw.choice(lines) for _ in range(draw.randint(0, 6)))) for i in ids]


def test_filter_inserts_deletes_and_grows():
    keys = np.random.default_rng(1).integers(0, 2**63, (60_000, 2)).astype(np.uint64)
    held = CuckooFilter()
    for part in np.array_split(keys[:40_000], [10, 500, 20_000]):
        held.insert(part)
    assert held.contains(keys[:40_000]).all()
    assert held.contains(keys[40_000:]).mean() < 0.005
    held.delete(keys[:30_000])
    held = CuckooFilter.from_bytes(held.to_bytes())
    assert held.contains(keys[30_000:40_000]).all()
    assert held.contains(keys[:30_000]).mean() < 0.005
    held.delete(keys[30_000:40_000])
    assert not any(layer.table.any() for layer in held.layers)


def test_batches_and_deletions_equal_a_new_index(spark, monkeypatch):
    monkeypatch.setattr(ld, "KEYS_PER_SHARD", 12)
    monkeypatch.setattr(ld, "ROWS_PER_TASK", 7)
    first, second, third = corpus(1, range(20, 40)), corpus(2, range(20)), corpus(3, range(40, 60))
    first += [(25, first[5][1]), (None, "a line with number 1"), (61, None), (62, "")]
    index = ld.LineIndex(spark)
    index.insert(frame(spark, first))
    assert result(index, frame(spark, first)) == brute(first)
    index.insert(frame(spark, second))
    assert result(index, frame(spark, first + second)) == brute(first + second)
    index.delete(spark.createDataFrame([(i,) for i in [*range(0, 30, 2), 999, None]], "doc_id long"))
    left = [(i, t) for i, t in first + second if i is None or i >= 30 or i % 2]
    assert result(index, frame(spark, left)) == brute(left)
    index.insert(frame(spark, third + [(2, second[2][1])]))
    left += third + [(2, second[2][1])]
    assert result(index, frame(spark, left)) == brute(left)
    zero = index.counts().where("refs = 0").count()
    assert zero == len(set(index.counts().where("refs = 0").select("key").toPandas()["key"].map(bytes)))


def test_hot_line_and_empty_table(spark):
    docs = [(i, "the very same line\nown line number %d" % i) for i in range(300)]
    index = ld.LineIndex(spark)
    index.insert(frame(spark, docs))
    assert result(index, frame(spark, docs)) == brute(docs)
    empty = ld.LineIndex(spark)
    empty.insert(frame(spark, docs).limit(0))
    assert result(empty, frame(spark, docs).limit(0)) == []
    empty.delete(spark.createDataFrame([(1,)], "doc_id long"))
    empty.insert(frame(spark, docs))
    assert result(empty, frame(spark, docs)) == brute(docs)
