import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cartloom.llm import langid


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    judged = langid.op4_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = judged[judged.held_out]
    assert len(held) > 250 and (held.lang == held.lang_pred).mean() > 0.98
    assert judged.score.between(0, 1).all()


def test_undetermined_texts_and_long_ones(spark):
    docs = [(i, text, lang, "x") for i, (text, lang) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, score string")
    models = langid.train(frame, F.lit(True))
    (model,) = models
    assert model.languages == ["de", "en"]
    texts = [None, "", " 12 %% ½ Ⅷ\n", "und der Garten", "the garden", "und der garten " * 40_000, "é", "漢字"]
    found = model.score(texts)
    assert [x for x, _ in found[:6]] == ["und", "und", "und", "de", "en", "de"]
    assert found[0] == ("und", 0.0) and all(x in model.languages for x, _ in found[6:])
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "the garden")], "doc_id long, text string")
    got = sorted((r.lang_pred, r.score) for r in langid.predict(rows, models).collect())
    want = sorted(found + [found[4]])
    assert [x for x, _ in got] == [x for x, _ in want] and [s for _, s in got] == pytest.approx([s for _, s in want])


def test_without_training_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    models = langid.train(empty, F.lit(True))
    docs = spark.createDataFrame([(1, "words"), (2, None)], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in langid.predict(docs, models).collect()] == [("und", 0.0)] * 2
    assert langid.predict(empty, models).collect() == []


def brute(training, texts):
    """Naive Bayes in dictionaries over the same features."""
    def features(text):
        codes = langid._codes(text)
        return Counter(int(x) for block in langid._buckets(codes) for x in block)

    counts, rows = defaultdict(Counter), Counter()
    for text, lang in training:
        counts[lang].update(features(text))
        rows[lang] += 1
    found = []
    for text in texts:
        totals = {}
        for lang in sorted(counts):
            whole = sum(counts[lang].values()) + 0.5 * langid.BUCKETS
            totals[lang] = math.log(rows[lang] / sum(rows.values())) + sum(n * math.log((counts[lang][x] + 0.5) / whole) for x, n in features(text).items())
        best = max(totals.values())
        lang = min(x for x, t in totals.items() if t > best - 1e-9)
        found.append((lang, 1 / sum(math.exp(t - best) for t in totals.values())))
    return found


@pytest.mark.parametrize("block", [256, 3])
def test_equals_brute_force_in_any_blocks(spark, monkeypatch, block):
    """Every language is learned and can be predicted, however many there are."""
    monkeypatch.setattr(langid, "BLOCK_LANGUAGES", block)
    syllables = ["ka", "lo", "mi", "né", "ru", "sta", "the", "un", "vo", "ich"]
    training = [(" ".join(syllables[(k * i + j) % 10] + syllables[(i + j) % 10] for j in range(4 + k)), f"l{i}") for i in range(8) for k in range(1, 4)]
    frame = spark.createDataFrame([(n, t, lang) for n, (t, lang) in enumerate(training)], "doc_id long, text string, lang string")
    models = langid.train(frame, F.lit(True))
    assert len(models) == -(-8 // block) and [x for m in models for x in m.languages] == [f"l{i}" for i in range(8)]
    texts = [t for t, _ in training] + ["the the", "k", "a long text with the vo un né " * 300]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r.lang_pred, r.score) for r in langid.predict(rows, models).orderBy("doc_id").collect()]
    want = brute(training, texts)
    assert [x for x, _ in got] == [x for x, _ in want] and len({x for x, _ in got}) == 8
    assert [s for _, s in got] == pytest.approx([s for _, s in want], rel=1e-3)
