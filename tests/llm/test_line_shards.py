import pytest

from cartloom.llm import line_dedup as ld
from tests.llm.test_line_dedup import brute, corpus, frame, result


def held(index, kind=ld.SEEN):
    return [sum(layer.held for layer in ld._load(index.filters[kind], s).layers) for s in range(index.shards)]


@pytest.mark.parametrize("first", [0, 1])
def test_shards_grow_with_the_keys(spark, monkeypatch, first):
    monkeypatch.setattr(ld, "KEYS_PER_SHARD", 40)
    docs = [(i, f"a line of its own {i}\nand another one {i}\na line of some {i % 7}") for i in range(200)]
    index = ld.LineIndex(spark)
    index.insert(frame(spark, docs).where(f"doc_id < {first}"))
    assert index.shards == 1
    index.insert(frame(spark, docs).where(f"doc_id >= {first} and doc_id < 60"))
    assert index.shards > 2
    index.insert(frame(spark, docs).where("doc_id >= 60"))
    keys = index.counts().where("refs > 0").count()
    assert keys == 407 and index.shards * 40 >= keys
    assert sum(held(index)) == keys and max(held(index)) < 80 and sum(held(index, ld.REPEATED)) == 7
    assert result(index, frame(spark, docs)) == brute(docs)
    index.delete(spark.createDataFrame([(i,) for i in range(0, 200, 3)], "doc_id long"))
    left = [d for d in docs if d[0] % 3]
    assert result(index, frame(spark, left)) == brute(left)
    more = corpus(4, range(300, 320))
    index.insert(frame(spark, more))
    assert result(index, frame(spark, left + more)) == brute(left + more)


def test_shards_do_not_grow_by_churn(spark, monkeypatch):
    monkeypatch.setattr(ld, "KEYS_PER_SHARD", 30)
    docs = [(i, f"a line of its own {i}") for i in range(25)]
    index = ld.LineIndex(spark)
    for _ in range(3):
        index.insert(frame(spark, docs))
        index.delete(spark.createDataFrame(docs, "doc_id long, text string").select("doc_id"))
    assert index.shards == 1 and sum(held(index)) == 0
