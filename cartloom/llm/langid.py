"""Language identification by multinomial naive Bayes over hashed character n-grams (operator 4).

Features of a text: its bigrams and trigrams of code points, lower-cased, with every ASCII character that is no
letter taken as a space and runs of spaces left as they are; each is hashed into one of ``BUCKETS`` buckets. The
model is a matrix of log probabilities (buckets x languages) and the log priors, broadcast to the tasks; four languages take half
a megabyte. Every language is learned. Beyond ``BLOCK_LANGUAGES`` (32 MB) there is one model for each block of languages, and
texts pass through them one after the other with the best score so far and the sum of all odds. Counting and scoring
go over whole texts in bounded blocks of positions.

The model is fitted on a bounded sample: about ``SAMPLE_PER_LANGUAGE`` training documents of each language,
chosen by a hash of their ids. Frequencies of languages are counted over all training documents.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. Without any training document every
text is ``und``. Rows of one doc_id are scored one by one. Of equal languages the first in ascending order wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import slices, table

BUCKETS = 1 << 15
BLOCK_LANGUAGES = 256
SAMPLE_PER_LANGUAGE = 1500
BLOCK = 1 << 18
LETTER = regex.compile(r"\p{L}")

_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, _FOLD[np.minimum(codes, 127)], codes)


def _buckets(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the bigrams and trigrams that start at each position of ``codes``."""
    a = codes * np.uint32(0x9E3779B1)
    b = codes * np.uint32(0x85EBCA77)
    c = codes * np.uint32(0xC2B2AE3D)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    two = a[:-1] + (b[1:] ^ (b[1:] >> np.uint32(15)))
    three = a[:-2] + (b[1:-1] ^ (b[1:-1] >> np.uint32(13))) + (c[2:] ^ (c[2:] >> np.uint32(11)))
    mix = np.uint32(0x27D4EB2F)
    return (two * mix) >> shift, ((three ^ (three >> np.uint32(16))) * mix) >> shift


def _blocks(text: str) -> Iterator[np.ndarray]:
    """Buckets of a whole text, a bounded number at a time."""
    codes = _codes(text)
    for i in range(0, max(1, len(codes) - 1), BLOCK):
        two, three = _buckets(codes[i : i + BLOCK + 2])
        yield two[:BLOCK]
        yield three[:BLOCK]


class Model:
    """Log probabilities of buckets and log priors of a block of languages, in ascending order of language."""

    def __init__(self, languages: list[str], priors: np.ndarray, counts: np.ndarray, all_rows: float | None = None) -> None:
        self.languages = languages
        self.priors = np.log(priors / (all_rows or priors.sum())) if len(languages) else priors
        smooth = counts + 0.5
        self.weights = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)

    def totals(self, text: str | None) -> np.ndarray | None:
        """Log of prior times likelihood of every language, from the sparse row of bucket counts; None if undetermined."""
        if not self.languages or text is None or not LETTER.search(text):
            return None
        counts = np.zeros(BUCKETS, np.int64)
        small = len(text) < BUCKETS // 4
        total = self.priors.copy()
        for block in _blocks(text):
            if small:
                total += self.weights[block].sum(axis=0, dtype=np.float64)
            else:
                counts += np.bincount(block, minlength=BUCKETS)
        if not small:
            hit = np.flatnonzero(counts)
            total += counts[hit] @ self.weights[hit].astype(np.float64)
        return total

    def best(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, its log odds, log of the sum of all odds) of each text."""
        found = []
        for text in texts:
            total = self.totals(text)
            if total is None:
                found.append(("und", -np.inf, -np.inf))
                continue
            most = int(total.argmax())
            found.append((self.languages[most], float(total[most]), float(total[most] + np.log(np.exp(total - total[most]).sum()))))
        return found

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and posterior probability of each text."""
        return [judged(*x) for x in self.best(texts)]


def judged(language: str, odds: float, whole: float) -> tuple[str, float]:
    return language, float(np.exp(odds - whole)) if language != "und" or np.isfinite(odds) else 0.0


def better(one: tuple[str, float, float], other: tuple[str, float, float]) -> tuple[str, float, float]:
    """The best of two blocks of languages, the first one first, and the sum of the odds of both."""
    whole = float(np.logaddexp(one[2], other[2]))
    return (*(other if other[1] > one[1] else one)[:2], whole)


def train(docs: DataFrame, is_training: Column) -> list[Model]:
    """Fit on a sample of the training rows of ``docs`` (doc_id, text, lang): one model per block of languages."""
    train_rows = docs.where(is_training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    rows = {r["lang"]: r["count"] for r in train_rows.groupBy("lang").count().collect()}
    languages, total = sorted(rows), float(sum(rows.values()))
    blocks = [languages[i : i + BLOCK_LANGUAGES] for i in range(0, len(languages), BLOCK_LANGUAGES)]
    return [_fit(train_rows, {x: rows[x] for x in block}, total) for block in blocks] or [Model([], np.zeros(0), np.zeros((BUCKETS, 0)))]


def _fit(train_rows: DataFrame, rows: dict[str, int], total: float) -> Model:
    languages = sorted(rows)
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, SAMPLE_PER_LANGUAGE / rows[lang]))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = train_rows.where(draw < F.try_element_at(share, F.col("lang")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for block in _blocks(text):
                    own += np.bincount(block, minlength=BUCKETS)
        for lang, own in sums.items():
            hit = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(hit)), pa.array(hit, pa.int32()), pa.array(own[hit], pa.int64())],
                names=["lang", "bucket", "n"])

    summed = sample.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    gathered = summed.toArrow()
    counts = np.zeros((BUCKETS, len(languages)))
    index = np.array([languages.index(x) for x in gathered.column("lang").unique().to_pylist()] or [0])
    codes = gathered.column("lang").combine_chunks().dictionary_encode().indices.to_numpy()
    counts[gathered.column("bucket").to_numpy(), index[codes] if len(codes) else codes] = gathered.column("n").to_numpy()
    return Model(languages, np.array([rows[x] for x in languages], float), counts, total)


def predict(docs: DataFrame, models: list[Model]) -> DataFrame:
    """Rows (doc_id, lang_pred, score) of ``docs`` (doc_id, text); only the text is looked at."""
    passed = docs.select(F.col("doc_id").cast("long"), "text", F.lit("und").alias("lang_pred"), F.lit(float("-inf")).alias("odds"), F.lit(float("-inf")).alias("whole"))
    names = passed.columns
    for number, model in enumerate(models):
        spread, last = docs.sparkSession.sparkContext.broadcast(model), number == len(models) - 1

        def run(batches: Iterator[pa.RecordBatch], spread=spread, last: bool = last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    before = zip(*(part.column(c).to_pylist() for c in names[2:]))
                    found = [better(a, b) for a, b in zip(before, spread.value.best(part.column("text").to_pylist()))]
                    texts = pa.nulls(len(part), pa.string()) if last else part.column("text")
                    yield pa.RecordBatch.from_arrays([
                        part.column("doc_id"), texts, pa.array([x for x, _, _ in found], pa.string()),
                        pa.array([x for _, x, _ in found], pa.float64()), pa.array([x for _, _, x in found], pa.float64()),
                    ], names=names)

        passed = passed.mapInArrow(run, "doc_id long, text string, lang_pred string, odds double, whole double")
    undetermined = F.col("odds") == float("-inf")
    score = F.when(undetermined, 0.0).otherwise(F.least(F.lit(1.0), F.exp(F.col("odds") - F.col("whole"))))
    return passed.select("doc_id", "lang_pred", score.alias("score"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    scored = predict(docs, train(docs, remainder != 1))
    return scored.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {"op4_language_id": (op4_language_id, None)}
