"""Content fingerprints of tables.

``hashed`` and ``summed`` cost one scan and no shuffle: the first hashes typed columns and is the cheapest,
the second sums digests of the canonical row text, which any engine can reproduce. ``bucketed`` keeps
the same sums per digest prefix and also tells where two tables differ. All of them merge from parts in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.rendering import hex_number, row_json

BUCKET_DIGITS = 3
DECIMAL = "decimal(38,0)"
SUMMAND = "decimal(28,0)"  # a sum of these is a decimal(38,0)


def row_digests(df: DataFrame, text: Column | None = None, keep: list[str] = ()) -> DataFrame:
    """``keep`` columns plus the md5 of the canonical row text."""
    return df.select(*keep, F.md5(row_json(df) if text is None else text).alias("digest"))


def _lane(first: int) -> Column:
    """Sum of a 60-bit slice of the row digests."""
    total = F.sum(hex_number(F.col("digest"), first, 15).cast(SUMMAND))
    return F.coalesce(total, F.lit(0)).cast(DECIMAL)


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("row_count"), _lane(1).alias("lane_a"), _lane(16).alias("lane_b")]


def summed(df: DataFrame, text: Column | None = None) -> DataFrame:
    """One row (row_count, lane_a, lane_b): order-free sums of two 60-bit slices of the row digests.

    Partial sums merge on the map side, so a third of equal rows costs nothing extra. Sums stay below
    10^38 up to 8 * 10^19 rows.
    """
    return row_digests(df, text).agg(*_sums())


def hashed(df: DataFrame) -> DataFrame:
    """One row (row_count, lane_a, lane_b): order-free sums of two 64-bit hashes of the typed row.

    NULLs do not enter the hash by themselves, so their positions are hashed too.
    """
    columns = [F.col(c) for c in df.columns]
    nulls = [F.col(f.name).isNull() for f in df.schema.fields if f.nullable]

    def lane(seed: int) -> Column:
        total = F.sum(F.xxhash64(F.lit(seed), *columns, *nulls).cast(SUMMAND))
        return F.coalesce(total, F.lit(0)).cast(DECIMAL)

    return df.agg(F.count(F.lit(1)).alias("row_count"), lane(1).alias("lane_a"), lane(2).alias("lane_b"))


def bucketed(df: DataFrame, digits: int = BUCKET_DIGITS, text: Column | None = None) -> DataFrame:
    """(bucket, row_count, lane_a, lane_b) of every prefix of ``digits`` hex digits of the row digest.

    The depth is a parameter and never follows the table, so fingerprints of all sizes can be compared. Buckets are
    sums, merged before the shuffle; a task sends at most ``16 ** digits`` rows.
    """
    return row_digests(df, text).groupBy(F.substring("digest", 1, digits).alias("bucket")).agg(*_sums())


def folded(buckets: DataFrame, digits: int = 0) -> DataFrame:
    """Buckets of a shorter prefix; with no digits one row, equal to ``summed``."""
    total = [F.coalesce(F.sum(F.col(c).cast(SUMMAND)), F.lit(0)).cast(DECIMAL).alias(c) for c in ("lane_a", "lane_b")]
    count = F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
    return buckets.groupBy(*[F.substring("bucket", 1, digits).alias("bucket")] * bool(digits)).agg(count, *total)


def of_tables(tables: dict[str, DataFrame], method=summed) -> DataFrame:
    """One fingerprint row per table, labelled with its name."""
    result = None
    for name in sorted(tables):
        row = method(tables[name])
        row = row.select(F.lit(name).alias("table_name"), *row.columns)
        result = row if result is None else result.unionByName(row)
    return result


def mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Tables whose fingerprint differs or exists on one side only."""
    values = [c for c in expected.columns if c != "table_name"]
    left = expected.select("table_name", F.struct(*values).alias("expected"))
    right = actual.select("table_name", F.struct(*values).alias("actual"))
    return left.join(right, "table_name", "full_outer").where(~F.col("expected").eqNullSafe(F.col("actual")))
