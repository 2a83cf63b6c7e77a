import itertools
import random

import numpy as np
import pytest

from cartloom.llm import sentencepiece_fst as fst

TEXTS = ["", " ", "  ", "a  b", "   x   y ", "▁▁a ▁b", "né\n\nà\t", "日本語テキスト 漢字", "😀 x😀y", "a" * 50, "hello" + " " * 37 + "world",
         "\x00\x01a", "1234567890 3.14159", "<s> </s> <0x0A>", "xx" * 600, "abab" * 50, "!!!!!!!! ...... ------"]


@pytest.fixture(scope="module")
def both():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return fst.Transducer(path), sentencepiece.SentencePieceProcessor(model_file=path), path


def test_same_ids_and_texts_as_the_library(both):
    own, library, _ = both
    draw = random.Random(1)
    texts = TEXTS + ["".join(draw.choice("abcdefghij ABCé.,  \n") for _ in range(draw.randint(1, 80))) for _ in range(500)]
    texts += ["".join(draw.choice(["th", "e", "an", "in", "ing", " ", "er", "  ", "tion"]) for _ in range(30)) for _ in range(500)]
    got = own.encode(texts)
    assert [x.tolist() for x in got] == library.encode(texts)
    assert [own.decode(x) for x in got] == [library.decode(x.tolist()) for x in got]


def test_unigram_paths_equal_brute_force():
    draw = np.random.default_rng(3)
    words = ["".join(w) for k in (1, 2, 3) for w in itertools.product("ab▁", repeat=k)]
    pieces = [("<unk>", 0.0, fst.UNKNOWN)] + [(w, -float(draw.integers(1, 60)) - draw.random(), fst.NORMAL) for w in words]
    model = fst.Transducer.of_pieces(pieces, fst.UNIGRAM)
    cost = {p: -s for p, s, t in pieces if t == fst.NORMAL}
    for text in ("a", "abba", "ab ab", "bbbaaab a"):
        whole = "▁" + text.replace(" ", "▁")
        ways = []
        for cuts in itertools.product((0, 1), repeat=len(whole) - 1):
            marks = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(whole)]
            parts = [whole[a:b] for a, b in zip(marks, marks[1:])]
            if all(p in cost for p in parts):
                ways.append((sum(cost[p] for p in parts), parts))
        got = model.encode([text])[0]
        assert [pieces[i][0] for i in got] == min(ways)[1]


def test_merges_of_a_small_model_step_by_step():
    words = ["a", "b", "c", "ab", "bc", "abc", "cab", "bcab"]
    model = fst.Transducer.of_pieces([("<unk>", 0.0, fst.UNKNOWN)] + [(w, -float(i), fst.NORMAL) for i, w in enumerate(words)], fst.BPE, prefix=False)
    for text in ("".join(t) for k in range(1, 8) for t in itertools.product("abc", repeat=k)):
        path: list[int] = []
        model._merges(text, path)
        assert model.encode([text])[0].tolist() == path, text


def test_query_over_rows(spark, both):
    own, library, path = both
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "y"), (3, "a  b", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = fst.encoded(docs, path, with_ids=False).collect()
    assert sorted((r.n_tokens, r.decoded_chars) for r in got) == sorted(
        (len(library.encode(t or "")), len(library.decode(library.encode(t or "")))) for _, t, _ in rows)
    arrays = fst.encode(docs, path)
    assert arrays.columns == ["doc_id", "text", "ids", "ids_"]
    assert all(r["ids_"] == library.encode(r["text"] or "") for r in arrays.collect())
    assert fst.encoded(spark.createDataFrame([], "doc_id long, text string"), path, with_ids=False).collect() == []


def test_unsupported_models_are_refused():
    with pytest.raises(FileNotFoundError):
        fst.Transducer("/nowhere.model")
