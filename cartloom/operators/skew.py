"""Size checks and hot-key handling shared by the joins and windows.

Hot keys are looked for before the job is planned, on a sample of bounded size. Only the few keys found
(at most ``MAX_CHUNKS``) come to the driver; they steer the plan and never change a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TASK_ROWS = 1_000_000
MAX_CHUNKS = 100_000
NULL_SALTS = 4096
SAMPLES_PER_CHUNK = 16
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
SAMPLE_SEED = 7


def rows_per_chunk(total: int, task_rows: int) -> int:
    """Rows one task should hold; grows with the table so that there are at most ``MAX_CHUNKS`` chunks."""
    return max(task_rows, total // MAX_CHUNKS + 1)


def bounded_sample(df: DataFrame, total: int, chunk: int) -> tuple[DataFrame, float]:
    """A sample of about ``SAMPLES_PER_CHUNK`` rows per chunk, and its fraction."""
    fraction = min(1.0, SAMPLES_PER_CHUNK / chunk)
    return (df if fraction >= 1.0 else df.sample(fraction=fraction, seed=SAMPLE_SEED)), fraction


def hot_keys(df: DataFrame, keys: list[str], task_rows: int = TASK_ROWS) -> DataFrame | None:
    """(keys, parts) of keys with more rows than one task should hold; None if there are none."""
    total = df.count()
    if total <= task_rows:
        return None
    chunk = rows_per_chunk(total, task_rows)
    sample, fraction = bounded_sample(df.select(*keys), total, chunk)
    parts = F.ceil(F.count(F.lit(1)) / F.lit(fraction * chunk)).cast("int").alias("parts")
    found = sample.groupBy(*keys).agg(parts).where("parts > 1")
    rows = found.collect()  # at most 2 * MAX_CHUNKS keys can hold more than one chunk
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def fits_broadcast(df: DataFrame, row_limit: int = BROADCAST_ROWS) -> bool:
    """Whether a relation was counted, and its texts measured, within the broadcast limits."""
    if df.count() > row_limit:
        return False
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    sizes = [F.octet_length(c) for c in texts] + [F.octet_length(F.to_json(F.struct(c))) for c in nested]
    if not sizes:
        return True
    measured = df.agg(*[F.coalesce(F.sum(size), F.lit(0)).alias(f"b{i}") for i, size in enumerate(sizes)]).first()
    return sum(measured) <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast only after measuring; a larger table keeps the shuffle join chosen by Spark."""
    return F.broadcast(df) if fits_broadcast(df) else df


def lookup(
    many: DataFrame,
    one: DataFrame,
    key: str | list[str],
    how: str = "inner",
    task_rows: int = TASK_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join many rows to at most one row per ``key`` (inner or left), whatever the skew of ``many``.

    A small ``one`` is broadcast after measuring it (not measured if ``broadcast_rows`` is 0). Otherwise a hot key
    of ``many`` is split over several tasks by a salt, and its single row of ``one`` is repeated once per salt.
    Rows with a NULL key match nothing; a left join spreads them by salts that ``one`` doesn't have.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup keeps or drops unmatched rows of the many side only: inner or left")
    key = [key] if isinstance(key, str) else key
    if broadcast_rows and fits_broadcast(one, broadcast_rows):
        return many.join(F.broadcast(one), key, how)
    # The salt depends on the row and its input split, so a repeated task gives the same one.
    spread = F.xxhash64(F.spark_partition_id(), *many.columns)
    null_key = F.lit(False)
    for k in key:
        null_key = null_key | F.col(k).isNull()
    salted_null = F.when(null_key, F.pmod(spread, F.lit(NULL_SALTS)) + MAX_CHUNKS)
    hot = hot_keys(many, key, task_rows)
    if hot is None:
        if how == "inner":
            return many.join(one, key, how)
        salted_many = many.withColumn("salt", F.coalesce(salted_null, F.lit(0)).cast("int"))
        return salted_many.join(one.withColumn("salt", F.lit(0)), [*key, "salt"], how).drop("salt")
    hot = F.broadcast(hot)
    parts = F.coalesce("parts", F.lit(1))
    salted_many = many.join(hot, key, "left").withColumn("salt", F.coalesce(salted_null, F.pmod(spread, parts)).cast("int")).drop("parts")
    salted_one = (
        one.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    )
    return salted_many.join(salted_one, [*key, "salt"], how).drop("salt")
