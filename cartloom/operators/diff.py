"""Differences between two versions of a relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.rendering import hex_number, row_json
from cartloom.operators.fingerprint import SUMMAND


def relation_diff(left: DataFrame, right: DataFrame, left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Distinct rows found on one side only, with a ``side`` label.

    Both directions come from one grouping (NULLs compare equal), so the rows are shuffled once and copies
    merge on the map side.
    """
    columns = left.columns
    if right.columns != columns:
        raise ValueError("both relations need the same columns in the same order")
    tagged = left.select("*", F.lit(1).alias("side__")).union(right.select("*", F.lit(2).alias("side__")))
    return (
        tagged.groupBy(*columns)
        .agg(F.min("side__").alias("lo__"), F.max("side__").alias("hi__"))
        .where("lo__ = hi__")
        .select(F.when(F.col("lo__") == 1, left_name).otherwise(right_name).alias("side"), *columns)
    )


def row_diff(before: DataFrame, after: DataFrame, key: list[str], text: Column | None = None) -> DataFrame:
    """(key, change): added, removed, changed, or repeated for a changed key that has several rows on a side.

    Both sides are reduced to one row per key, a count and an order-free sum of row digests, in one grouping that
    merges before the shuffle. So copies of a key never meet in pairs, and NULL keys are keys like others.
    """
    columns = before.columns

    def digested(df: DataFrame, side: int) -> DataFrame:
        digest = F.md5(row_json(df, columns) if text is None else text)
        return df.select(*key, F.lit(side).alias("side__"), digest.alias("digest"))

    def total(side: int, first: int) -> Column:
        part = F.when(F.col("side__") == side, hex_number(F.col("digest"), first, 15).cast(SUMMAND))
        return F.coalesce(F.sum(part), F.lit(0))

    counted = digested(before, 1).union(digested(after, 2)).groupBy(*key).agg(
        F.count_if(F.col("side__") == 1).alias("n1__"), F.count_if(F.col("side__") == 2).alias("n2__"),
        F.struct(total(1, 1), total(1, 16)).alias("d1__"), F.struct(total(2, 1), total(2, 16)).alias("d2__"),
    )
    differs = (F.col("n1__") != F.col("n2__")) | (F.col("d1__") != F.col("d2__"))
    change = (
        F.when(F.col("n1__") == 0, "added").when(F.col("n2__") == 0, "removed")
        .when(F.greatest("n1__", "n2__") > 1, "repeated").otherwise("changed")
    )
    return counted.where(differs).select(*key, change.alias("change"))
