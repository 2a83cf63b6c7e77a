import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cartloom.llm import collocations as c

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, top, longest=5):
    """The contract in dictionaries."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if 1 < len(p) and a >= least}
        inside = defaultdict(int)
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        scored = []
        for p, a in found.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), " ".join(p), l, r))
        for rank, (score, a, _, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase, -a, l, r, n[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[x] for x in COLUMNS) for r in df.collect())


def corpus(seed, documents=120, words=14):
    """Short texts of few words: many repeated runs, overlapping ones, all separators."""
    draw = np.random.default_rng(seed)
    names = np.array(["a", "B", "c,", "the", "The", "é", "x.y", "d\t", "\n", "long-word", "q?", "", " ", "a"])
    return [(str(draw.choice(["en", "de"])) if draw.random() < 0.9 else None, " ".join(draw.choice(names[:words], draw.integers(0, 60))))
            for _ in range(documents)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = [*corpus(seed), ("en", None), ("en", ""), ("und", "a b c the a b c"), ("x\ny", "a a a a a a " * 20), ("", "a b a b a b " * 20)]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, text string, n int, phrase string").repartition(4)
    want = brute(rows, 12, 25)
    assert len(want) > 40 and len({r[0] for r in want}) >= 4
    assert rows_of(c.collocations(docs, 12, 25)) == want


def test_small_chunks_and_partitions(spark, monkeypatch):
    """Chunks of a few words, texts cut over several of them, many hash partitions, and all chunks of the driver's settings."""
    monkeypatch.setattr(c, "CHUNK_BYTES", 64)
    monkeypatch.setattr(c, "PART_MASS", 40)
    rows = corpus(3, documents=60)
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(2)
    assert rows_of(c.collocations(docs, 5, 30)) == brute(rows, 5, 30)


@pytest.mark.parametrize("spare", [1, 4])
def test_every_frequent_key_survives(spare):
    draw = np.random.default_rng(spare)
    keys = np.concatenate([draw.integers(0, 2**63, 40_000), np.repeat(draw.integers(0, 2**63, 60), draw.integers(80, 140, 60))]).astype(np.uint64)
    draw.shuffle(keys)
    exact = Counter(keys.tolist())
    least = 100
    summary = c.Misra(max(1, spare * len(keys) // least))
    for part in np.array_split(keys, 97):
        summary.merge(*np.unique(part, return_counts=True))
        summary._settle()
        assert len(summary.keys) <= summary.capacity
    kept = set(summary.survivors(least).tolist())
    assert summary.taken < least
    assert {k for k, n in exact.items() if n >= least} <= kept
    assert len(kept) < 5 * len(exact) / 100


def test_packed_keys():
    draw = np.random.default_rng(5)
    for n in (0, 1, 1000):
        keys = np.sort(draw.integers(0, 2**64, n, dtype=np.uint64) & c._HASH)
        assert (c._unpack_keys(c._pack_keys(keys), n) == keys).all() and c._unpacked(c._packed(keys), n).tolist() == keys.tolist()


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """With hashes of four bits nearly all runs collide; counts stay exact."""
    mix = c._mix
    monkeypatch.setattr(c, "_mix", lambda x: mix(x) & np.uint64(0xF << 60))
    rows = corpus(4, documents=40)
    folder = None

    def run(part):
        nonlocal folder
        import tempfile

        folder = folder or "file://" + tempfile.mkdtemp()
        return c._write([(t or "").lower().encode() for _, t in part], ["en"] * len(part), folder)[0][0]

    name = run(rows)
    chunk = c._Chunk(folder, name)
    chunk._extend(5)
    got = Counter()
    counted = chunk.counted(5)
    for words, phrase, n in zip(*(counted.column(x).to_pylist() for x in ("words", "phrase", "n"))):
        got[tuple(phrase.split(" "))] += n
        assert len(phrase.split(" ")) == words
    want = Counter()
    for _, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").lower().replace("É", "é")):
            w = re.findall("[^ \t]+", piece)
            for size in range(1, 6):
                want.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    assert got == want


def test_large_products_stay_exact(spark):
    """Counts whose products pass 64 bits."""
    big = 3 * 10**11
    known = spark.createDataFrame([("en", 1, "a", big + 7), ("en", 1, "b", big + 1), ("en", 2, "a b", big)], "lang string, words int, phrase string, a long")
    totals = spark.createDataFrame([("en", 10**15 + 3)], "lang string, n long")
    original = c.frequent
    c.frequent = lambda docs, least: (totals, known)
    try:
        assert rows_of(c.collocations(None)) == [("en", 1, "a b", big, big + 7, big + 1, 10**15 + 3, 1000 * big * (10**15 + 3) // ((big + 7) * (big + 1)))]
    finally:
        c.frequent = original


def test_empty_tables(spark):
    assert c.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert c.collocations(spark.createDataFrame([("en", None), (None, "...")], "lang string, text string"), least=1).collect() == []


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{folder}/documents.parquet'")
    assert rows_of(c.op11_collocations(spark, folder)) == sorted(con.sql(f"select {', '.join(COLUMNS)} from ({c.SQL})").fetchall())


def test_ranks_are_cut_before_a_language_meets(spark):
    plan = c.op11_collocations(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert len(windows) == 2 and "bucket" in windows[1] and "bucket" not in windows[0]
