"""Helpers shared by the operators: table access, the shared scratch folder, bounded slices of Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.session import cut_lineage

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, if they don't have it on their path anyway.

    On a cluster whose machines don't share that place, the submitter ships the package (``--py-files``).
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size of what ``df`` reads; it steers layouts only, never results."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared checkpoint folder, as a URI that every executor can open."""
    reach(spark)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        cut_lineage(spark.range(1))
    return f"{context.getCheckpointDir()}/{purpose}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def beside(df: DataFrame, most_rows: int = 1 << 20) -> DataFrame:
    """A checkpointed ``df`` of short rows, marked for broadcast if it is counted to be small."""
    return F.broadcast(df) if df.count() <= most_rows else df


def _give_back() -> None:
    """Return free memory of Arrow's pool and of the C library to the system, where these can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` whose task leaves no free memory behind: Python workers are reused by later stages."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return whole


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose ``column`` holds about ``most`` bytes; a longer value is a piece of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > most or i - start >= 4096):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)
