"""Keys and references between tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, copies) of key values that occur more than once; NULL never collides."""
    return (
        df.where(~any_null(columns))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def referenced(child: DataFrame, foreign_key: str, name: str = "key", count: str = "child_rows") -> DataFrame:
    """(key, child_rows): distinct non-NULL references, merged on the map side."""
    return (
        child.where(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias(name))
        .agg(F.count(F.lit(1)).alias(count))
    )


def orphans(
    child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str, unique_parent: bool = True
) -> DataFrame:
    """(key, child_rows) of references without a parent row.

    The child side is reduced to distinct keys before the join, so a hot key joins as one row. A parent
    column that is not a key needs the same: ``unique_parent=False``.
    """
    keys = parent.select(F.col(primary_key).alias("key"))
    keys = keys if unique_parent else keys.distinct()
    return referenced(child, foreign_key).join(keys, "key", "left_anti")


def reference_profile(parent: DataFrame, primary_key: str, children: list[tuple[DataFrame, str]]) -> DataFrame:
    """(key, in_parent, in_child_0, in_child_1, ...): how often each key occurs in the parent and in each child.

    All references to one parent are answered by this single grouping: an orphan is a key with no parent
    row, a childless key has no child row, a duplicate occurs twice in the parent. Nothing is joined, every
    table sends its merged keys through one shuffle, and the parent does so only once.
    """
    sides = [(parent, primary_key), *children]
    marks = ["in_parent", *[f"in_child_{i}" for i in range(len(children))]]
    tagged = [
        df.where(F.col(column).isNotNull()).select(
            F.col(column).alias("key"), *[F.lit(int(j == i)).cast("bigint").alias(m) for j, m in enumerate(marks)]
        )
        for i, (df, column) in enumerate(sides)
    ]
    return reduce(DataFrame.unionByName, tagged).groupBy("key").agg(*[F.sum(m).alias(m) for m in marks])


def without_children(parent: DataFrame, primary_key: str, child: DataFrame, foreign_key: str) -> DataFrame:
    """Parent rows that no child row refers to."""
    used = referenced(child, foreign_key, primary_key).select(primary_key)
    return parent.join(used, primary_key, "left_anti")


def child_counts(parent: DataFrame, primary_key: str, child: DataFrame, foreign_key: str, count: str) -> DataFrame:
    """Every parent key with its number of child rows, 0 included."""
    used = referenced(child, foreign_key, primary_key, count)
    return (
        parent.select(primary_key)
        .join(used, primary_key, "left")
        .select(primary_key, F.coalesce(count, F.lit(0).cast("bigint")).alias(count))
    )
