"""Parquet tables and small CSV reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header into declared types; a malformed line is an error, nothing is inferred."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST", enforceSchema=False)


def write_csv_report(df: DataFrame, path: str, order: list[str]) -> None:
    """Sorted one-file CSV for reports, whose rows are counts and checks and not table rows."""
    df.orderBy(*order).coalesce(1).write.csv(path, header=True, mode="error")
