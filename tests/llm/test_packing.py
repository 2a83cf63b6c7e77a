import heapq
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cartloom.llm import packing

TEXTS = ["", None, " ", "a  b", "x \n y", "Plain WORDS, here", " lead", "trail ", "tab\t x", "it's 12 o'clock 's", "né à la  ça\n\nfin ",
         "<|endoftext|> a b<|startoftext|>c", "<|EndOfText|>", "日本 語", "e ́x", "J̌x Á a, b., c!\n D; X.", "ΟΔΟΣ ΣΑΣ", "  ",
         "Long text, " * 9000, "many words here " * 700, "Plain WORDS, here"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def padding(lengths):
    return sum(0 if n & (n - 1) == 0 else packing.CAPACITY - n for n in lengths)


def plain_differencing(sizes, windows):
    """Lengths of the windows by lists of items, with the same rule for ties."""
    heap = [(-s if windows > 1 else 0, i, [[s]] + [[] for _ in range(windows - 1)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        (_, _, a), (_, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        merged = sorted((x + y for x, y in zip(a, reversed(b))), key=sum, reverse=True)
        heapq.heappush(heap, (sum(merged[-1]) - sum(merged[0]), n, merged))
        n += 1
    return sorted(sum(w) for w in heap[0][2])


@pytest.mark.parametrize("n, windows", [(1, 1), (3, 5), (40, 3), (200, 16)])
def test_differencing_equals_lists_of_items(n, windows):
    sizes = np.random.default_rng(n).integers(1, 4096, n)
    window, filled = packing.differenced(sizes, windows)
    assert np.bincount(window, sizes, windows).tolist() == filled.tolist()
    assert sorted(filled.tolist()) == plain_differencing(sizes.tolist(), windows)


@pytest.mark.parametrize("sizes", [[5], [1] * 300, [2100] * 250, [4095] * 100, [3000] * 200, [4095, 1, 2, 3], [1400] * 300, [4090] * 3, [4096] * 4, [2048]])
def test_blocks_are_whole_and_nearly_full(sizes):
    sizes = np.array(sizes)
    item, start, length, sequence = packing.plan(sizes)
    assert np.bincount(item, length, len(sizes)).tolist() == sizes.tolist()
    order = np.lexsort((start, item))
    assert all((s == 0) if i == 0 or item[order][i - 1] != item[order][i] else s == (start + length)[order][i - 1] for i, s in enumerate(start[order]))
    filled = np.bincount(sequence, length).astype(int).tolist()
    assert max(filled) <= packing.CAPACITY and min(filled) > 0 and (np.diff(sequence) >= 0).all()
    assert padding(filled) <= max(packing.CAPACITY, 0.005 * sizes.sum())


def test_the_count_rises_until_nothing_exceeds_the_capacity():
    item, _, length, sequence = packing.plan(np.full(7, 60), capacity=64)
    assert np.bincount(sequence, length).max() <= 64 and np.bincount(item, length).tolist() == [60] * 7


def test_encoder_equals_the_library(library, monkeypatch):
    path, tokenizer = library
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in TEXTS]
    encoder = packing.Encoder(path, 2)
    assert [x.tolist() for x in encoder.ids(TEXTS)] == want
    monkeypatch.setattr(packing, "PART_BYTES", 7)
    assert [x.tolist() for x in encoder.ids(TEXTS[:-3])] == want[:-3]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_BYTES", 1200)
    path, tokenizer = library
    encoder = packing.Encoder(path, 2)
    for _ in range(2):
        for t in TEXTS[:18]:
            assert encoder.ids([t])[0].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
    assert 0 < len(encoder.memory.numbers) < 12


def check(rows, texts, library):
    """Every id of every document lies in one piece; sequences are gapless and within the capacity."""
    path, tokenizer = library
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    filled = []
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
        filled.append(at)
    return filled


def test_query_over_the_table(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = packing.op12_packing(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    filled = check(rows, {r.doc_id: r.text for r in docs}, library)
    assert padding(filled) <= 0.01 * sum(filled)


def test_defined_cases(spark, library):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "null id", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids string, length int").repartition(3).cache()
    from pyspark.sql import functions as F

    got = packing.pack(docs, library[0], 2).withColumn("ids_crc32", F.crc32("ids")).collect()
    check(got, {d: t for d, t, *_ in rows}, library)
    assert len({r.sequence_id >> 33 for r in got}) == 3
    twice = spark.createDataFrame([(1, "a b"), (1, "c")], "doc_id long, text string").coalesce(1)
    assert sorted((r.doc_tokens) for r in packing.pack(twice, library[0], 2).collect() if r.start == 0) == [2, 3]
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), library[0], 2).collect() == []
