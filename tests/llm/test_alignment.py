import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cartloom.llm import alignment

TEXTS = ["", None, " ", "a  b", "x \n y", "Plain words, here", " lead", "trail ", "tab\t x", "it's 12 o'clock 's", "né à la  ça\n\nfin ",
         "<|endoftext|> a b</s><s>", "日本 語 𠀀𠀁", "e ́x", "a▁b plain words", "emoji 🧿x 🏴󠁧 ͸ y", "\r\nx", "nul \x00 x", "<0x41> <unk>",
         "Plain words, here", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 5, "🧿🧿🧿" * 40, "Ĝh ġ é", "line\nline two\nwords, here",
         "here, there. Where? é, , x. ., so! a;", "here , there"]


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def brute(paths):
    """[(n_a, n_b, n_groups, n_links, n_best, count_sum, digest)] of texts, by whole texts and loops over pairs."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(paths[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    alphabet = alignment.byte_alphabet()

    def groups_of(text):
        if not text:
            return []
        data = (" " + text).encode()
        a = [(i, bytes(alphabet[c] for c in a_side.id_to_token(i))) for i in a_side.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[1:-1], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode())
             for i in b_side.encode(text) for p in [b_side.id_to_piece(i)]]
        if any(b"".join(x for _, x in side) != data for side in (a, b)):
            return []
        found, i, j, at_a, at_b, own = [], 0, 0, 0, 0, ([], [])
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                own[0].append(a[i][0])
                at_a, i = at_a + len(a[i][1]), i + 1
            else:
                own[1].append(b[j][0])
                at_b, j = at_b + len(b[j][1]), j + 1
            if at_a == at_b:
                found.append(own)
                own = ([], [])
        return found

    def run(texts):
        documents = [groups_of(t) for t in texts]
        held, best = Counter(), defaultdict(int)
        for groups in documents:
            held.update({(x, y) for xs, ys in groups for x in xs for y in ys})
        for (x, _), n in held.items():
            best[x] = max(best[x], n)
        rows = []
        for groups in documents:
            links = [(x, y) for xs, ys in groups for x in xs for y in ys]
            shown = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
            rows.append((sum(len(xs) for xs, _ in groups), sum(len(ys) for _, ys in groups), len(groups), len(links),
                         sum(held[k] == best[k[0]] for k in links), sum(held[k] for k in links),
                         hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
        return rows

    return run


def rows_of(df):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.orderBy("doc_id").collect()]


def test_spans_and_decoded_bytes_agree(paths):
    """The ends found from spans are the running sums of decoded bytes, also inside characters."""
    pair = alignment.Pair(*paths)
    for text in filter(None, TEXTS):
        found = pair.ends(text)
        if found is None:
            assert "▁" in text
            continue
        a, a_ends, b, b_ends = found
        assert a_ends.tolist() == np.cumsum(pair.a_sizes[a]).tolist()
        assert b_ends.tolist() == np.cumsum(pair.b_sizes[b]).tolist()


def test_defined_cases(spark, paths, brute):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id int, text string, chunk string, a int").repartition(3)
    assert rows_of(alignment.aligned(docs, *paths)) == brute(TEXTS)


def test_small_chunks_little_memory_and_large_groups(spark, paths, brute, monkeypatch):
    """Chunk files of single documents, units forgotten at once, and every group kept as distinct pairs."""
    import sys

    pair = alignment.Pair(*paths)
    monkeypatch.setattr(alignment, "MANY_LINKS", 0)
    monkeypatch.setattr(pair.memory, "most", 500)
    texts = [t or "" for t in TEXTS] * 2
    whole = brute(texts)
    for k in range(0, len(texts), 5):
        units, before = pair.place(texts[k : k + 5])
        for own, want in zip(units, whole[k : k + 5]):
            assert np.maximum(pair.facts.get(own)[0].reshape(-1, 4).sum(axis=0), 0).tolist() == list(want[:4])
            assert pair.decoded(pair.links.get(own)[0])[1].sum() == want[3]
        pair.settle(before)
    assert len(pair.memory.numbers) == pair.facts.n == len(pair.groups) < 6
    assert sys.getsizeof(pair.groups) < 10_000


def test_query_over_the_table(spark, brute):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    assert rows_of(alignment.op13_alignment(spark, folder)) == brute([d.text for d in docs])


def test_repeated_and_null_ids_count_one_by_one(spark, paths, brute):
    rows = [(1, "some words here"), (1, "some words here"), (None, "other words"), (1, None)]
    got = alignment.aligned(spark.createDataFrame(rows, "doc_id long, text string"), *paths).collect()
    want = brute([t for _, t in rows])
    assert sorted((r.doc_id or 0, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == sorted((d or 0, *w[3:]) for (d, _), w in zip(rows, want))
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), *paths).collect() == []
