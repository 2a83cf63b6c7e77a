"""Parquet tables bucketed by a key, so that joins and groupings by it read them without a shuffle.

The files lie in a folder of the caller's; the session's catalog only says how they are bucketed. Another session attaches the
same folder with the number of buckets it was written with. One task writes one bucket, as one sorted file. The key must be
a primary key, or at least have no hot value: a bucket is as large as its rows. A join reads a bucket in one task, so buckets are
smaller than the files of a snapshot.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cartloom.operators.profiling import quoted
from cartloom.sources.snapshot import file_count


ROWS_PER_BUCKET = 500_000
MAX_BUCKETS = 100_000  # Spark's limit, unless it is raised


@dataclass(frozen=True)
class Bucketed:
    name: str
    rows: DataFrame
    buckets: int


def _name() -> str:
    return f"bucketed_{uuid.uuid4().hex}"


def write(df: DataFrame, path: str, key: list[str], buckets: int | None = None) -> Bucketed:
    """Write ``df`` in buckets by ``key``; their number follows rows and bytes unless it is given."""
    if buckets is None:
        rows = df.count()
        buckets = min(MAX_BUCKETS, max(file_count(df, rows), -(-rows // ROWS_PER_BUCKET)))
    name = _name()
    dealt = df.repartition(buckets, *[quoted(c) for c in key])
    dealt.write.bucketBy(buckets, *key).sortBy(*key).option("path", path).saveAsTable(name, format="parquet", mode="error")
    return Bucketed(name, df.sparkSession.table(name), buckets)


def attach(spark: SparkSession, path: str, schema: T.StructType, key: list[str], buckets: int) -> Bucketed:
    """A bucketed folder that another session wrote."""
    name = _name()
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    listed = ", ".join(quoted(c) for c in key)
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{location}'")
    return Bucketed(name, spark.table(name), buckets)


def forget(spark: SparkSession, table: Bucketed) -> None:
    """Take the table out of the session's catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table.name}")
