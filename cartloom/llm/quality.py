"""Quality classifier: a byte-level convolutional network in numpy (operator 8).

A text is its UTF-8 bytes, cut into chunks of ``CHUNK`` bytes that overlap by half, so the chunks cover the whole
text. ``FILTERS`` learned filters of ``WIDTH`` bytes (one weight per place, byte value and filter) slide over each
chunk and are max-pooled in it. The document takes the mean and the maximum of its chunks' pooled values, and one
logistic unit combines them into a probability. For speed the weights of neighbouring places are added up in
advance, so a filter costs one lookup for every two bytes of its width.

Training is plain stochastic gradient descent with Adam, on whole texts and on short pieces of some good ones. Gradients of the filters only touch the places where
a maximum was found. It runs on a bounded sample: at most ``SAMPLE_PER_CLASS`` rows of each class,
chosen by a hash of their ids, and at most ``SAMPLE_BYTES`` of text, of which each class has half and what the other
leaves. Of a longer text the sample holds the first ``LONGEST`` bytes, so that no text fills it alone and
every class with a labelled row is learned. Scores are of whole texts always.

Defined cases: a null text is an empty one, and an empty text is one chunk of zero bytes, which has a score like any other.
With no labelled row, or rows of one class only, every score is the share of good rows (1 if there are none), so
nothing is rejected for lack of labels. Of several labels for one doc_id the lowest counts. Rows of one doc_id are
scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cartloom.llm.common import slices, table

CHUNK = 256
STEP = CHUNK // 2
WIDTH = 6
FILTERS = 32
SAMPLE_PER_CLASS = 1500
SAMPLE_BYTES = 24 << 20
LONGEST = 1 << 16
EPOCHS = 12
LEAST_STEPS = 400
SNIPPETS_EVERY = 4
BATCH = 32
RATE = 0.02
THRESHOLD = 0.3
BLOCK_CHUNKS = 1024


def chunk_starts(size: int) -> np.ndarray:
    return np.arange(0, max(1, size - CHUNK + STEP), STEP)


def padded(text: bytes) -> np.ndarray:
    """The bytes, filled up with zeros so that every chunk and every filter place in it exists."""
    n = int(chunk_starts(len(text))[-1]) + CHUNK + WIDTH
    out = np.zeros(n, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out


class Network:
    def __init__(self, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)
        self.filters = (draw.standard_normal((WIDTH, 256, FILTERS)) * 0.1).astype(np.float32)
        self.out = np.zeros(2 * FILTERS + 1, np.float32)
        self.constant: float | None = None
        self._pairs()

    def _pairs(self) -> None:
        f = self.filters
        self.pairs = [(f[j][:, None, :] + f[j + 1][None, :, :]).reshape(65536, FILTERS) for j in range(0, WIDTH, 2)]

    def _pooled(self, data: np.ndarray, first: int, count: int, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Max over each of ``count`` chunks from chunk ``first`` on, and the place of the maximum if asked for."""
        part = data[first * STEP : (first + count + 1) * STEP + WIDTH]
        two = part[:-1].astype(np.uint16) * np.uint16(256) + part[1:]
        n = (count + 1) * STEP
        values = self.pairs[0][two[:n]]
        for j in range(1, len(self.pairs)):
            values += self.pairs[j][two[2 * j : 2 * j + n]]
        halves = values.reshape(count + 1, STEP, FILTERS)
        top = halves.max(axis=1)
        pooled = np.maximum(top[:-1], top[1:])
        if not places:
            return pooled, None
        at = halves.argmax(axis=1) + np.arange(count + 1)[:, None] * STEP
        return pooled, np.where(top[:-1] >= top[1:], at[:-1], at[1:]) + first * STEP

    def features(self, text: bytes) -> np.ndarray:
        data, chunks = padded(text), len(chunk_starts(len(text)))
        total, most = np.zeros(FILTERS), np.full(FILTERS, -np.inf)
        for first in range(0, chunks, BLOCK_CHUNKS):
            pooled = np.tanh(self._pooled(data, first, min(BLOCK_CHUNKS, chunks - first))[0])
            total += pooled.sum(axis=0, dtype=np.float64)
            most = np.maximum(most, pooled.max(axis=0))
        return np.concatenate([total / chunks, most, [1.0]])

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        logit = float(self.features((text or "").encode("utf-8", "surrogatepass")) @ self.out)
        return float(1 / (1 + np.exp(-np.clip(logit, -40, 40))))

    def fit(self, texts: list[bytes], labels: list[int], seed: int = 7) -> None:
        good = np.asarray(labels, float)
        if len(good) == 0 or good.min() == good.max():
            self.constant = float(good.mean()) if len(good) else 1.0
            return
        draw = np.random.default_rng(seed)
        # every few good texts also give a short piece, as short good documents are rare in a sample
        pieces = []
        for text in [t for t, g in zip(texts, labels) if g][::SNIPPETS_EVERY]:
            size, words = int(draw.integers(15, 120)), text.split(b" ")
            first = int(draw.integers(0, len(words)))
            pieces.append(b" ".join(words[first : first + 1 + size // 6]))
        texts, good = [*texts, *pieces], np.append(good, np.ones(len(pieces)))
        moments = [np.zeros_like(x) for x in (self.filters, self.filters, self.out, self.out)]
        step = 0
        epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(texts)))  # a small sample is passed more often
        for epoch in range(epochs):
            order = draw.permutation(len(texts))
            rate = RATE * (1 - epoch / epochs)
            for i in range(0, len(order), BATCH):
                d_filters, d_out = np.zeros_like(self.filters), np.zeros_like(self.out)
                chosen = order[i : i + BATCH]
                for k in chosen:
                    self._gradient(texts[k], good[k], 1 / len(chosen), d_filters, d_out)
                step += 1
                for x, g, m, v in ((self.filters, d_filters, *moments[:2]), (self.out, d_out, *moments[2:])):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
                self._pairs()

    def _gradient(self, text: bytes, good: float, weight: float, d_filters: np.ndarray, d_out: np.ndarray) -> None:
        data, chunks = padded(text), len(chunk_starts(len(text)))
        parts = [self._pooled(data, first, min(BLOCK_CHUNKS, chunks - first), places=True) for first in range(0, chunks, BLOCK_CHUNKS)]
        pooled = np.tanh(np.concatenate([p for p, _ in parts]))
        places = np.concatenate([a for _, a in parts])
        top = pooled.argmax(axis=0)
        x = np.concatenate([pooled.mean(axis=0), pooled[top, np.arange(FILTERS)], [1.0]])
        error = weight * (1 / (1 + np.exp(-np.clip(x @ self.out, -40, 40))) - good)
        d_out += error * x
        d_pooled = np.repeat((error * self.out[None, :FILTERS] / chunks), chunks, axis=0)
        d_pooled[top, np.arange(FILTERS)] += error * self.out[FILTERS:-1]
        d_pooled *= 1 - pooled * pooled
        if not self.out.any():  # the first step of all: let the filters move towards their signs
            return
        column = np.broadcast_to(np.arange(FILTERS), places.shape)
        for j in range(WIDTH):
            np.add.at(d_filters[j], (data[places + j], column), d_pooled)


def train(docs: DataFrame, labels: DataFrame, is_training: Column) -> Network:
    """Fit on a bounded sample of ``docs`` (doc_id, text) with ``labels`` (doc_id, quality)."""
    known = labels.where(is_training & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).withColumn("draw", F.xxhash64("doc_id"))
    sample = None
    for quality in (0, 1):
        part = known.where(F.col("quality") == quality).orderBy("draw", "doc_id").limit(SAMPLE_PER_CLASS)
        sample = part if sample is None else sample.union(part)
    part = F.substring(F.coalesce("text", F.lit("")).cast("binary"), 1, LONGEST)
    texts = docs.select("doc_id", part.alias("text")).join(F.broadcast(sample), "doc_id")
    own = Window.partitionBy("quality").orderBy("draw", "doc_id", "text")
    first = texts.withColumn("place", F.row_number().over(own)).where(F.col("place") <= SAMPLE_PER_CLASS)
    so_far = F.sum(F.octet_length("text")).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = first.withColumn("so_far", so_far).where(F.col("so_far") <= SAMPLE_BYTES).select("text", "quality", "draw", "doc_id", "so_far").toArrow()
    rows = found.sort_by([(c, "ascending") for c in ("draw", "doc_id", "text")]).to_pydict()
    held = {q: max((n for n, k in zip(rows["so_far"], rows["quality"]) if k == q), default=0) for q in (0, 1)}
    most = {q: max(SAMPLE_BYTES // 2, SAMPLE_BYTES - held[1 - q]) for q in (0, 1)}
    kept = [(t, q) for t, q, n in zip(rows["text"], rows["quality"], rows["so_far"]) if n <= most[q]]
    network = Network()
    network.fit([t for t, _ in kept], [q for _, q in kept])
    return network


def score(docs: DataFrame, network: Network) -> DataFrame:
    """``docs`` with all its columns and ``score_of_quality``; only the text is looked at."""
    spread = docs.sparkSession.sparkContext.broadcast(network)
    name = "score_of_quality"
    while name in docs.columns:
        name += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                scores = [spread.value.score(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("long"), "text")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    scored = score(docs, train(docs, table(spark, folder, "labels"), remainder != 0))
    return scored.select(
        "doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), F.col("score_of_quality").alias("score"),
        (F.col("score_of_quality") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op8_quality": (op8_quality, None)}
