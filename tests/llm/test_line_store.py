"""An index of lines that is opened again, and changes that fail half way."""

import random

import pytest

from cartloom.llm import line_dedup as ld


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def corpus(first, last, seed):
    draw = random.Random(seed)
    return [(i, "\n".join(f"a line of the corpus {draw.randrange(60)}" for _ in range(draw.randrange(6)))) for i in range(first, last)]


def cleaned(spark, index, docs):
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in index.clean(frame(spark, docs)).collect()}


def plain(docs):
    first = {}
    for i, text in docs:
        for key in {ld.key_of(x) for x in text.encode().split(b"\n")} - {None}:
            first[key] = min(i, first.get(key, i))
    found = {}
    for i, text in docs:
        kept = [x for x in text.split("\n") if ld.key_of(x.encode()) is None or first[ld.key_of(x.encode())] == i]
        found[i] = ("\n".join(kept), len(text.split("\n")), len(text.split("\n")) - len(kept))
    return found


def test_another_session_goes_on_with_an_index(spark, tmp_path):
    folder = f"file://{tmp_path}/index"
    one, two = corpus(0, 40, 1), corpus(40, 80, 2)
    ld.LineIndex(spark, folder).insert(frame(spark, one))
    again = ld.LineIndex(spark, folder)
    assert (again.version, again.shards) == (1, 1)
    assert cleaned(spark, again, one) == plain(one)
    again.insert(frame(spark, two))
    third = ld.LineIndex(spark, folder)
    third.delete(spark.createDataFrame([(i,) for i in range(0, 80, 3)], "doc_id long"))
    held = [d for d in one + two if d[0] % 3]
    assert cleaned(spark, ld.LineIndex(spark, folder), held) == cleaned(spark, third, held) == plain(held)


def test_a_change_that_fails_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/index"
    one, two = corpus(0, 30, 3), corpus(30, 60, 4)
    index = ld.LineIndex(spark, folder)
    index.insert(frame(spark, one))

    def fail(*_, **__):
        raise OSError("an executor's disk is full")

    gone = spark.createDataFrame([(0,), (1,)], "doc_id long")
    for place in ("_refilter", "_commit"):  # references and counts are written by then, or all but the state is
        with monkeypatch.context() as broken:
            broken.setattr(ld.LineIndex, place, fail)
            with pytest.raises(OSError):
                index.insert(frame(spark, two))
            with pytest.raises(OSError):
                index.delete(gone)
        assert index.version == 1
        assert cleaned(spark, index, one) == cleaned(spark, ld.LineIndex(spark, folder), one) == plain(one)
    index.insert(frame(spark, two))
    index.delete(gone)
    held = (one + two)[2:]
    assert cleaned(spark, ld.LineIndex(spark, folder), held) == plain(held)


def test_two_writers_of_one_version(spark, tmp_path):
    folder = f"file://{tmp_path}/index"
    first, second = ld.LineIndex(spark, folder), ld.LineIndex(spark, folder)
    one, two = corpus(0, 10, 5), corpus(10, 20, 6)
    first.insert(frame(spark, one))
    with pytest.raises(RuntimeError, match="another writer"):
        second.insert(frame(spark, two))
    assert second.version == 0
    assert cleaned(spark, ld.LineIndex(spark, folder), one) == plain(one)
