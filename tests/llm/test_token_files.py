import zlib

import numpy as np
import pytest

from cartloom.llm import token_files as tf

TEXTS = ["", None, " ", "a  b", "x \n y", "plain words, here", " lead", "trail ", "tab\t x", "it's 12 o'clock",
         "né à la  ça\n\nfin ", "<|endoftext|> a", "日本 語", "  nb  sp", "\x1c a \x1c", "plain words, here"]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 25, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001).astype(np.uint32)
    assert (tf.unpack(tf.pack(ids, bits), bits, len(ids)) == ids).all()
    assert len(tf.pack(ids, bits)) == -(-len(ids) * bits // 8)


def test_units_give_the_ids_of_whole_texts(tokenizer):
    path, library = tokenizer
    texts = [t or "" for t in TEXTS]
    own = tf.Encoder(path)
    got = own.ids(texts)
    assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_random_access(tmp_path):
    ids = [np.random.default_rng(i).integers(0, 50_000, n).astype(np.uint32) for i, n in enumerate((70_000, 0, 3, 140_000))]
    writer = tf.ShardWriter(f"file://{tmp_path}", "a.ids", 17)
    for i, x in enumerate(ids):
        writer.add(i if i else None, x)
    assert writer.close() == sum(map(len, ids))
    reader = tf.ShardReader(f"file://{tmp_path}", "a.ids")
    flat = np.concatenate(ids)
    for start, count in ((0, 5), (65_530, 20), (69_999, 100_000), (len(flat) - 1, 1), (9, 0)):
        assert (reader.ids(start, count) == flat[start : start + count]).all()
    assert [d for d, *_ in reader.documents()] == [None, 1, 2, 3]
    assert [p.name for p in tmp_path.iterdir()] == ["a.ids"]


def test_files_equal_the_library(spark, tokenizer, tmp_path):
    path, library = tokenizer
    rows = [(i if i != 4 else None, t, "x", 5) for i, t in enumerate(TEXTS)] + [(3, "a  b", "y", 6), (3, "again", "y", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, n_ids int").repartition(5)
    got = tf.read(tf.write(docs, path, 0, f"file://{tmp_path}", shard_bytes=10), f"file://{tmp_path}").collect()
    encoded = [(d, library.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, *_ in rows]
    want = sorted(((-1 if d is None else d), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in encoded)
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *[r.n_tokens for r in ordered]])[:-1].tolist()
    known = [r.doc_id for r in ordered]
    assert known[0] is None and known[1:] == sorted(known[1:])


def test_empty_table(spark, tokenizer, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tf.read(tf.write(docs, tokenizer[0], 0, f"file://{tmp_path}"), f"file://{tmp_path}").collect() == []
