"""Expected row counts as a relation, so that two contracts of counts can be diffed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.generate.profile import Profile

COUNT_SCHEMA = "profile string, table_name string, row_count bigint"


def expected_counts(spark: SparkSession, profiles: list[Profile]) -> DataFrame:
    rows = [(p.name, table, n) for p in profiles for table, n in p.expected_counts().items()]
    return spark.createDataFrame(rows, COUNT_SCHEMA)


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """(table_name, left_rows, right_rows) of two relations (table_name, row_count) where they differ; NULL where a side has no row."""
    joined = left.select("table_name", F.col("row_count").alias("left_rows")).join(
        right.select("table_name", F.col("row_count").alias("right_rows")), "table_name", "full")
    return joined.where("NOT left_rows <=> right_rows")
