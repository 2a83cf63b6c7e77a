"""Stored digests of a table version as a tree of buckets, so that two versions are compared where they differ only.

``write`` reduces a table to one row per key (a count and order-free sums of its row digests; copies of a key merge before
the shuffle) and stores it twice: the keys in folders by bucket, a prefix of the key's md5, and the sums of every prefix
from the root down. ``changes`` goes down both trees from the root, at each depth only below the nodes that differ, and
reads the key folders of the buckets that it ends in, no others. Equal versions cost two rows.

A bucket's sums are 2 x 60 bits of md5 sums and a count, as in fingerprints. The depth is a parameter and is stored; versions to be
compared need the same. A depth of ``digits`` makes ``16 ** digits`` folders: choose it so that a folder fills a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.rendering import row_json
from cartloom.operators.fingerprint import DECIMAL, SUMMAND, _sums, row_digests

DIGITS = 2
_VALUES = ["row_count", "lane_a", "lane_b"]


def write(df: DataFrame, key: list[str], folder: str, digits: int = DIGITS, text: Column | None = None) -> None:
    """Store the digests of ``df`` by ``key`` (any number of rows per key, NULLs included) under a new ``folder``."""
    if not 1 <= digits <= 4:
        raise ValueError("one to four digits")
    per_key = row_digests(df, text, keep=key).groupBy(*key).agg(*_sums())
    bucket = F.substring(F.md5(row_json(per_key.select(*key))), 1, digits)
    per_key.withColumn("bucket", bucket).repartition(16**digits, "bucket").write.partitionBy("bucket").parquet(f"{folder}/keys")
    # The schema is given, as buckets like 01 would else be read as numbers.
    leaves = _keys(df.sparkSession, folder, per_key.schema.simpleString()).groupBy("bucket").agg(*_added())
    every = leaves.select(F.explode(F.sequence(F.lit(0), F.lit(digits))).alias("depth"), "*")
    nodes = every.groupBy("depth", F.expr("substring(bucket, 1, depth)").alias("prefix")).agg(*_added())
    nodes.coalesce(1).sortWithinPartitions("depth", "prefix").write.partitionBy("depth").parquet(f"{folder}/tree")
    # Last, so that a tree without it is known to be unfinished.
    marker = df.sparkSession.createDataFrame([(digits, ",".join(key), per_key.schema.simpleString())], "digits int, key string, kind string")
    marker.coalesce(1).write.parquet(f"{folder}/complete")


def _added() -> list[Column]:
    lanes = [F.sum(F.col(c).cast(SUMMAND)).cast(DECIMAL).alias(c) for c in ("lane_a", "lane_b")]
    return [F.sum("row_count").alias("row_count"), *lanes]


def _keys(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    fields = kind.removeprefix("struct<").removesuffix(">")
    return spark.read.schema(f"{fields},bucket:string".replace(":", " ")).parquet(f"{folder}/keys")


def _marker(spark: SparkSession, folder: str):
    return spark.read.parquet(f"{folder}/complete").first()


def _nodes(spark: SparkSession, folder: str, depth: int) -> DataFrame:
    kind = f"prefix string, row_count long, lane_a {DECIMAL}, lane_b {DECIMAL}, depth int"
    return spark.read.schema(kind).parquet(f"{folder}/tree").where(F.col("depth") == depth).select("prefix", F.struct(*_VALUES).alias("v"))


def differing(spark: SparkSession, before: str, after: str) -> list[str]:
    """Buckets that differ, found from the root down; each depth reads the children of the nodes that differ above it."""
    one, other = _marker(spark, before), _marker(spark, after)
    if (one.digits, one.key) != (other.digits, other.key):
        raise ValueError("the versions have trees of different depth or key")
    found = [""]
    for depth in range(one.digits + 1):
        wanted = F.substring("prefix", 1, max(0, depth - 1)).isin(found)  # at most 16 ** digits prefixes
        left, right = (_nodes(spark, f, depth).where(wanted) for f in (before, after))
        both = left.withColumnRenamed("v", "a").join(right.withColumnRenamed("v", "b"), "prefix", "full_outer")
        found = [r.prefix for r in both.where(~F.col("a").eqNullSafe(F.col("b"))).select("prefix").collect()]
        if not found:
            return []
    return sorted(found)


def changes(spark: SparkSession, before: str, after: str) -> DataFrame:
    """(key, change) between two written versions: added, removed, changed, or repeated for a changed key of several rows."""
    marker = _marker(spark, before)
    key = marker.key.split(",")
    buckets = differing(spark, before, after)
    sides = [_keys(spark, f, _marker(spark, f).kind).where(F.col("bucket").isin(buckets)).select(*key, F.lit(s).alias("side"), *_VALUES)
             for s, f in ((1, before), (2, after))]
    of = lambda side: [F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{c}{side}") for c in _VALUES]
    counted = sides[0].unionByName(sides[1]).groupBy(*key).agg(*of(1), *of(2))
    differs = F.lit(False)
    for c in _VALUES:
        differs = differs | ~F.col(f"{c}1").eqNullSafe(F.col(f"{c}2"))
    change = (F.when(F.col("row_count1").isNull(), "added").when(F.col("row_count2").isNull(), "removed")
              .when(F.greatest("row_count1", "row_count2") > 1, "repeated").otherwise("changed"))
    return counted.where(differs).select(*key, change.alias("change"))
