"""Exact top-k by inner product with three phases of a uniform threshold (operator 3).

Vectors are turned into integers, ``floor(scale * x)`` per component in double precision. Candidates are held in the
tasks that read them; each candidate's score is known to one task only, so the lists of the tasks are disjoint and
one cutoff per query serves all of them.

1. Every task makes a local list of each query's ``k`` best scores. Scores come from a float32 product here, whose error
   is bounded by ``error`` (from the norms), so a list holds safe lower bounds: score minus error.
2. The k-th best lower bound of all lists of a query is a safe cutoff, as at least k candidates reach it. Cutoffs are
   broadcast, 8 bytes a query.
3. Every task collects all candidates whose score plus error reaches the cutoff, however many, resolves their
   scores exactly with integers and passes on its k best by (score, smaller id), of which the k best of all are taken.

Queries are dealt over rounds of at most ``ROUND_BYTES``, by a count of rows and components, so the broadcast is
bounded, and a block of candidates is met by at most ``BLOCK_CELLS`` products at a time; each round reads the candidates twice. If all products are whole numbers below 2^24, float32 is exact
and the error is zero.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part. Vectors only meet those
of the same number of components. Rows that share an id are candidates of their own, but not of a query with that id;
equal queries that share an id are answered once, different ones share one answer, of all their scores. Scores whose
parts may pass 63 bits are summed in integers of any length; components and scores that leave 63 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import table
from cartloom.session import cut_lineage

ROUND_BYTES = 16 << 20
BLOCK_ROWS = 4096
BLOCK_CELLS = 1 << 21
SCALE = 1024


def integers(rows: DataFrame, vector: str, scale: int) -> DataFrame:
    """``rows`` with the vector as ``array<int>`` in ``parts``, without rows whose vector takes no part."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    whole = F.transform(x, lambda v: F.when(F.abs(v.cast("double") * float(scale)) < 2.0**62, F.floor(v.cast("double") * float(scale)))
                        .otherwise(F.raise_error(F.lit("a component leaves 63 bits"))).cast("long"))
    return rows.where((F.size(x) > 0) & ~F.coalesce(bad, F.lit(True))).withColumn("parts", whole)


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and ends of a list column."""
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))


class Queries:
    """Queries of a round, grouped by the number of components."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]) -> None:
        self.groups: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = np.array([len(v) for v in vectors])
        for d in np.unique(sizes):
            own = np.flatnonzero(sizes == d)
            self.groups[int(d)] = (ids[own], np.stack([vectors[i] for i in own]).astype(np.int64))


def _blocks(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of rows with the same number of components, so few at a time that their products are bounded."""
    most = max((len(ids) for ids, _ in queries.groups.values()), default=1)
    size = max(1, min(BLOCK_ROWS, BLOCK_CELLS // most))
    for batch in batches:
        for i in range(0, len(batch), size):
            part = batch.slice(i, size)
            ids = part.column("vec_id").to_numpy(zero_copy_only=False)
            flat, ends = _matrix(part.column("parts"))
            sizes = np.diff(np.append(0, ends))
            for d in np.unique(sizes):
                own = np.flatnonzero(sizes == d)
                rows = (ends[own] - d)[:, None] + np.arange(d)
                yield ids[own], flat[rows].astype(np.int64)


def _approximate(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """float32 products (queries x rows) and a bound of their error for each query."""
    q, r = queries.astype(np.float32), rows.astype(np.float32)
    norms = np.sqrt((queries.astype(np.float64) ** 2).sum(1)) * np.sqrt((rows.astype(np.float64) ** 2).sum(1).max(initial=0))
    exact = max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0)) < 1 << 24 and norms.max(initial=0) < 1 << 24
    # each of the d products and sums is off by at most 2^-23 of the sum of absolute products; inputs round once more
    error = np.zeros(len(q)) if exact else norms * (rows.shape[1] + 4) * 2.0**-23 + 1e-3
    return q @ r.T, error


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two integer matrices."""
    most = np.sqrt((left.astype(np.float64) ** 2).sum(1).max(initial=0) * (right.astype(np.float64) ** 2).sum(1).max(initial=0))
    if most < 2.0**62:  # no product and, added in any order modulo 2^64, no sum can be wrong
        return np.einsum("ij,ij->i", left, right)
    sums = (left.astype(object) * right.astype(object)).sum(axis=1)
    if any(abs(s) >= 1 << 63 for s in sums):
        raise OverflowError("a score leaves 63 bits")
    return sums.astype(np.int64)


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of ``rows`` for each of ``queries`` (both vec_id, parts)."""
    spark = rows.sparkSession
    # rows of one id and vector are answered once
    queries = cut_lineage(queries.select(F.col("vec_id").cast("long").alias("vec_id"), "parts").where("vec_id IS NOT NULL").distinct())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "parts").where("vec_id IS NOT NULL")
    size = queries.agg(F.coalesce(F.sum(F.size("parts") * 8 + 64), F.lit(0))).first()[0]
    rounds = max(1, -(-size // ROUND_BYTES))
    found = None
    for r in range(rounds):
        own = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == r) if rounds > 1 else queries
        part = _round(spark, rows, own, k)
        if part is not None:
            part = cut_lineage(part) if rounds > 1 else part
            found = part if found is None else found.union(part)
    empty = "query_id long, rank int, vec_id long, score long"
    return found if found is not None else spark.createDataFrame([], empty)


def _round(spark: SparkSession, rows: DataFrame, queries: DataFrame, k: int) -> DataFrame | None:
    got = queries.toArrow()
    if not len(got):
        return None
    flat, ends = _matrix(got.column("parts").combine_chunks())
    ids = got.column("vec_id").to_numpy()
    spread = spark.sparkContext.broadcast(Queries(ids, np.split(flat.astype(np.int64), ends[:-1])))

    def local_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for row_ids, block in _blocks(batches, spread.value):
            if block.shape[1] not in spread.value.groups:
                continue
            query_ids, vectors = spread.value.groups[block.shape[1]]
            score, error = _approximate(vectors, block)
            score = score.astype(np.float64) - error[:, None]
            score[query_ids[:, None] == row_ids[None, :]] = -np.inf
            held = np.concatenate([best[block.shape[1]], score], axis=1) if block.shape[1] in best else score
            best[block.shape[1]] = -np.partition(-held, k - 1, axis=1)[:, :k] if held.shape[1] > k else held
        for d, lists in best.items():
            query_ids = spread.value.groups[d][0]
            at = np.nonzero(np.isfinite(lists))
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[at[0]]), pa.array(lists[at])], names=["query_id", "bound"])

    bounds = rows.mapInArrow(local_lists, "query_id long, bound double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound")))
    cutoffs = bounds.withColumn("place", place).where(F.col("place") <= k).where(F.col("place") == k).toArrow()
    cutoff = spark.sparkContext.broadcast(dict(zip(cutoffs.column("query_id").to_pylist(), cutoffs.column("bound").to_pylist())))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        least = {d: np.array([cutoff.value.get(q, -np.inf) for q in ids.tolist()]) for d, (ids, _) in spread.value.groups.items()}
        for row_ids, block in _blocks(batches, spread.value):
            d = block.shape[1]
            if d not in spread.value.groups:
                continue
            query_ids, vectors = spread.value.groups[d]
            score, error = _approximate(vectors, block)
            reach = score.astype(np.float64) + error[:, None] >= least[d][:, None]
            reach &= query_ids[:, None] != row_ids[None, :]
            q, r = np.nonzero(reach)
            for i in range(0, len(q), BLOCK_ROWS * 16):
                a, b = q[i : i + BLOCK_ROWS * 16], r[i : i + BLOCK_ROWS * 16]
                new = a, row_ids[b].astype(np.int64), _exact(vectors[a], block[b])
                a, ids, exact = (np.concatenate(x) for x in zip(best[d], new)) if d in best else new
                by = np.lexsort((ids, -exact, a))  # of what reaches the cutoff only the k best of this task can win
                a, ids, exact = a[by], ids[by], exact[by]
                kept = np.arange(len(a)) - np.searchsorted(a, a) < k
                best[d] = a[kept], ids[kept], exact[kept]
        for d, (a, ids, exact) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(spread.value.groups[d][0][a]), pa.array(ids), pa.array(exact)], names=["query_id", "vec_id", "score"])

    collected = rows.mapInArrow(entries, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return collected.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = integers(table(spark, folder, "embeddings"), "embedding", SCALE)
    return top_k(rows, rows.where("vec_id % 100 = 0"), k=10)


OP3_SQL = f"""
WITH v AS (
  SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS p
  FROM embeddings WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), e AS (SELECT vec_id, generate_subscripts(p, 1) AS i, unnest(p) AS x FROM v),
s AS (
  SELECT q.vec_id AS query_id, e.vec_id, CAST(sum(q.x * e.x) AS BIGINT) AS score
  FROM e AS q JOIN e ON q.i = e.i AND q.vec_id <> e.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

QUERIES = {"op3_top_k": (op3_top_k, OP3_SQL)}
