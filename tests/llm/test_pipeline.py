"""The pipeline, stage by stage, against plain Python over the same rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from cartloom.llm import quality
from tests.llm.test_decontaminate import brute as brute_windows
from tests.llm.test_jaccard import brute as brute_groups
from tests.llm.test_line_dedup import brute as brute_lines

FOLDER = "/root/testdata/sf0.001"


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


def test_quality_stage(spark, documents):
    kept = pipeline.keep_good(spark, documents, FOLDER)
    assert kept.columns == documents.columns
    network = quality.train(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"), F.lit(True))
    assert pairs(kept) == sorted(((i, t) for i, t in pairs(documents) if network.score(t) >= 0.3), key=str)
    bad = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 0").collect()}
    assert not bad & {i for i, _ in pairs(kept)}


def test_line_stage(spark, documents):
    kept = pipeline.drop_repeated_lines(spark, documents, FOLDER)
    assert kept.columns == documents.columns
    want = [(i, text) for i, text, _, dropped in brute_lines(pairs(documents)) if not dropped or text.strip(" ")]
    assert pairs(kept) == sorted(want, key=str)
    assert kept.where("n_chars <> length(text)").isEmpty() or not documents.where("n_chars <> length(text)").isEmpty()


def test_near_duplicate_stage(spark, documents):
    kept = pipeline.drop_near_duplicates(spark, documents, FOLDER)
    assert kept.columns == documents.columns
    stay = {c for _, _, c in brute_groups(pairs(documents), 5, 80)}
    assert pairs(kept) == [(i, t) for i, t in pairs(documents) if i in stay]


def test_decontamination_stage(spark, documents):
    kept = pipeline.drop_contaminated(spark, documents, FOLDER)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = {i for i, _, hit, _ in brute_windows(pairs(documents), items, 10) if not hit}
    assert pairs(kept) == [(i, t) for i, t in pairs(documents) if i in clean]


def test_token_stage(spark, documents):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = dict(pairs(documents))
    for r in pipeline.encode(spark, documents, FOLDER).collect():
        assert r.ids == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_whole_run_equals_its_stages(spark, documents):
    docs = documents
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), documents.schema)
    want = pipeline.encode(spark, docs, FOLDER).drop("ids").collect()
    got = pipeline.run(spark, FOLDER).drop("ids").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 100


def test_stages_with_nulls_extra_columns_and_no_rows(spark, documents):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, n_lines int"
    rows = [(None, "no id but words in it", "en", None, 21, "x", 1), (1, None, None, "s", None, "x", 1), (2, "", "en", "s", 0, None, None),
            (3, "the same line of words\nand one more line", "en", "s", 40, "x", 1), (3, "the same line of words\nand one more line", "en", "s", 40, "x", 1), (4, "the same line of words", "en", "s", 22, "y", 2)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in pipeline.STAGES[1:-1]:
            docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), schema)
            assert docs.columns == [c.split()[0] for c in schema.split(", ")], name
        left = sorted((r.doc_id or 0, r.text) for r in docs.collect() if r.text)
        assert left == ([(0, "no id but words in it"), (3, "the same line of words\nand one more line")] if given else [])
        assert pipeline.encode(spark, docs, FOLDER).count() == docs.count()
        assert pipeline.keep_good(spark, docs, FOLDER).columns == docs.columns


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    scored = quality.op8_quality(spark, folder)
    judged = scored.where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    assert np.mean(judged.predicted == judged.quality) > 0.9
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").isEmpty()


def test_quality_without_labels_keeps_everything(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    network = quality.train(docs, labels, F.lit(True))
    assert [r[-1] for r in quality.score(docs, network).collect()] == [1.0] * 3
    long = quality.Network()
    long.fit([b"good words here " * 20, b"%%% $$$ ### " * 20] * 8, [1, 0] * 8)
    assert long.score("good words here " * 30_000) > 0.5 > long.score("%%% $$$ ### " * 30_000)
    assert 0 <= long.score(None) == long.score("") <= 1
