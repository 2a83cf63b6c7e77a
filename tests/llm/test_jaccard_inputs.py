import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from cartloom.llm import jaccard

FOLDER = "/root/testdata/sf0.001"


def dealt_anew(docs):
    """Rows of ``docs`` that go to other tasks each time they are computed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = pa.array([int.from_bytes(os.urandom(4), "little") for _ in range(len(batch))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, place], names=["doc_id", "text", "place"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, text string, place long")
    return rows.repartition(7, "place").drop("place")


def test_inputs_that_derive_from_files(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    moving = dealt_anew(docs)
    assert moving.inputFiles()
    found = jaccard.linked(moving, 3, 90).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, jaccard.linked(docs, 3, 90).collect()))


def test_plain_scans(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert jaccard._plain_scan(docs) and jaccard._plain_scan(docs.select(F.col("doc_id").cast("long"), "text").where("doc_id > 3"))
    for other in (docs.repartition(3), docs.join(docs.select("doc_id"), "doc_id"), docs.where(F.rand() < 0.5), docs.distinct(), dealt_anew(docs), spark.range(3)):
        assert not jaccard._plain_scan(other)
