import pytest
from pyspark.sql import functions as F

from cartloom.llm import quality

BYTES = quality.SAMPLE_BYTES


@pytest.fixture
def sampled(monkeypatch):
    """What the network is given to learn from."""
    seen = []
    monkeypatch.setattr(quality.Network, "fit", lambda self, texts, labels: seen.append((texts, labels)))
    return seen


def ordered(spark, n):
    """Ids in the order in which the sample takes them."""
    return [r.id for r in spark.range(n).orderBy(F.xxhash64("id"), "id").collect()]


def frames(spark, rows):
    """``rows``: (doc_id, quality, characters, a character)."""
    plan = spark.createDataFrame(rows, "doc_id long, quality int, size int, letter string")
    return plan.select("doc_id", F.expr("repeat(letter, size)").alias("text")), plan.select("doc_id", "quality")


@pytest.mark.parametrize("letter", ["x", "漢", "😀"])
@pytest.mark.parametrize("place", [0, 5, 39])
def test_a_long_text_does_not_end_the_sample(spark, sampled, place, letter):
    rows = [(i, k % 2, BYTES + 1 if k == place else 50, letter) for k, i in enumerate(ordered(spark, 40))]
    quality.train(*frames(spark, rows), F.lit(True))
    texts, labels = sampled[0]
    assert labels == [k % 2 for k in range(40)]
    assert [len(t) for t in texts] == [quality.LONGEST if k == place else 50 * len(letter.encode()) for k in range(40)]


def test_only_long_texts_are_learned(spark, sampled):
    quality.train(*frames(spark, [(i, i % 2, BYTES + 1, "ab"[i % 2]) for i in range(4)]), F.lit(True))
    assert sorted(sampled[0][1]) == [0, 0, 1, 1]


def test_each_class_has_its_share_of_bytes(spark, sampled, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 10_000)
    ids = ordered(spark, 300)
    rows = [(i, int(k % 10 != 9), 200, "x") for k, i in enumerate(ids)]  # 270 good ones, 30 bad ones
    quality.train(*frames(spark, rows), F.lit(True))
    labels = sampled[0][1]
    assert (labels.count(0), labels.count(1)) == (25, 25)
    quality.train(*frames(spark, [r for r in rows if r[1] or r[0] in ids[:100]]), F.lit(True))
    labels = sampled[1][1]
    assert (labels.count(0), labels.count(1)) == (10, 40)  # one class takes what the other leaves


def test_rows_of_one_doc_id_are_bounded(spark, sampled):
    docs = spark.range(2000).select(F.lit(1).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    docs = docs.union(spark.createDataFrame([(2, None)], "doc_id long, text string"))
    quality.train(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"), F.lit(True))
    assert sampled[0][1].count(1) == quality.SAMPLE_PER_CLASS and sampled[0][1].count(0) == 1
