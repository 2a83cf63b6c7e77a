"""N-gram Jaccard join with rare-first prefix filtering (operator 9).

A document's set holds the 64-bit hashes of its distinct word shingles. Two documents link when
``100 * intersection >= percent * union``, by whole numbers. The stages:

1. Documents with equal sequences of words are one class, named by the smallest doc_id; the rest is about classes.
2. Rarity is exact where it matters most: whether any other class holds a shingle. Tasks ask in chunks of about
   ``CHUNK_TOKENS`` distinct shingles, each cut by ranges of the hash; a task per range counts what all chunks hold and
   answers one bit for each shingle asked for. A shingle is asked for once per chunk, however many documents hold it.
   (Hashes of 40 bits serve here; where two coincide, a shingle may pass for shared, which costs candidates only.)
   Shared shingles are ordered by a table of ``COUNTERS`` hashed counters over all classes, 8 MB whatever the input.
   The order of all shingles is (shared, counter, hash). Results don't depend on it, as any total order is right.
3. A linked pair shares at least one of the first ``n - ceil(percent * n / 100) + 1`` of both sets. Of this
   prefix the shared shingles are indexed; others can't match. Classes that hold the same meet at the smallest of
   them, their hub, once however many of its shingles they hold, so a shingle of any number of classes gives as many rows.
   There sketches of the sets are compared: one bit per bucket of hashes, whether it holds an odd number. Two
   sketches differ in no more bits than the sets in shingles, so a linked pair always passes, and one that only shares
   passages or met by chance does not. (The larger a corpus is, the more classes meet by chance; without the sketches their ties grow into one
   neighbourhood, faster than the input.) Of the pairs that pass at a hub a forest goes out; tied classes are a neighbourhood
   (``components``). Hubs of more than ``HUB_ROWS`` rows or ``HUB_BYTES`` of sketches are split like neighbourhoods below.
4. Neighbourhoods are dealt over cells. One of more than ``CELL_CLASSES`` classes or ``CELL_SHINGLES`` shingles is
   split into parts, and each pair of parts is a cell, so no task gets more than two parts. One of more than ``MOST_PARTS``
   parts is reduced first: sketches ``FINER`` times as wide are compared as at a hub, the sets of a class and of up to two that it
   is tied to are compared, which gives trees of linked classes, and only classes outside the largest tree meet all others.
5. Within a cell, prefix shingles are joined, and a pair passes the length filter, the positional filter at its first
   common shingle and the suffix filter (both sets are cut into parts; the overlap is at most the sum of the
   smaller counts) before its intersection is counted, once. Pairs that links found already tie together
   need no count. A cell returns a tree for each component, never pairs.
6. Components of the trees are the result.

Stages 2 and 3 pass over the same rows in the same order, which holds for plain scans of files; other inputs are written first.

Defined cases: texts that are null or without words have an empty set and link with nothing; rows that share a doc_id
count as one document, whose component is that of all its rows; a row with a null doc_id takes no part, and its
component is null. Of equal rows all are returned. An empty table gives no rows.
"""

from __future__ import annotations

import copy
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import beside, materialized, plan_bytes, released, shared_folder, slices, table
from cartloom.llm.components import components
from cartloom.llm.shingles import parts_of
from cartloom.llm.units import ranges
from cartloom.operators.ordered import dense_row_number
from cartloom.session import cut_lineage

COUNTERS = 1 << 21
SLICES = 64
CHUNK_TOKENS = 1 << 20
RANGE_TOKENS = 1 << 20
TOKEN_BITS = 40
HUB_ROWS = 1 << 16
HUB_BYTES = 16 << 20
FEW = 16
BLOCK_WORDS = 1 << 19
CELL_CLASSES = 256
CELL_SHINGLES = 1 << 20
PARTS = 16
MOST_PARTS = 16
FINER = 16
CHILDREN = 256


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def least_overlap(a: np.ndarray, b: int, percent: int) -> np.ndarray:
    """The smallest intersection with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def most_apart(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles only one of two linked sets of these sizes can hold; -1 where sizes alone forbid a link."""
    need = least_overlap(a, b, percent)
    return np.where(need <= np.minimum(a, b), a + b - 2 * need, -1)


def _scale(percent: int, finer: int = 1) -> int:
    """Buckets of a sketch for each shingle, at least; fewer than twice as many at most."""
    return (1 if percent >= 75 else 4) * finer


def sketch(own: np.ndarray, percent: int, finer: int = 1) -> bytes:
    """Of distinct shingles, a bit per bucket: whether an odd number falls into it. Buckets are a power of two that follows the size."""
    bits = 1 << max(8, (len(own) * _scale(percent, finer) - 1).bit_length())
    odd = np.bincount((own >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class Sketches:
    """Sizes and sketches of many sets, compared by their row numbers; of ``finer`` ones narrow copies are compared first."""

    def __init__(self, sizes: np.ndarray, column: pa.BinaryArray, percent: int, finer: int = 1) -> None:
        self.sizes, self.percent = sizes, percent
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // 8
        self.flat = np.frombuffer(data, np.uint64, int(ends[-1]))
        self.starts, self.words = ends[:-1], np.diff(ends)
        self.rough = self._narrow(finer) if finer > 1 else None

    def _narrow(self, by: int) -> Sketches:
        rough = copy.copy(self)
        rough.words = np.maximum(np.minimum(self.words, 4), self.words // by)
        ends = np.cumsum(rough.words)
        rough.starts, rough.flat, rough.rough = ends - rough.words, np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64), None
        for width in np.unique(self.words):
            at = np.flatnonzero(self.words == width)
            step = max(1, BLOCK_WORDS // int(width))
            for k in range(0, len(at), step):
                some = at[k : k + step]
                words = int(rough.words[some[0]])
                rough.flat[rough.starts[some][:, None] + np.arange(words)] = self._folded(some, words)
        return rough

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """In how many bits each pair differs, the wider sketch folded to the width of the other."""
        found = np.zeros(len(i), np.int64)
        widths = self.words[i] << 32 | self.words[j]
        for width in np.unique(widths):
            at, wide, slim = np.flatnonzero(widths == width), int(width) >> 32, int(width) & (1 << 32) - 1
            step = max(1, BLOCK_WORDS // max(wide, slim))
            for k in range(0, len(at), step):
                some = at[k : k + step]
                x, y = self._folded(i[some], min(wide, slim)), self._folded(j[some], min(wide, slim))
                found[some] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        return found

    def _folded(self, rows: np.ndarray, words: int) -> np.ndarray:
        """Sketches of one width, of which parts of ``words`` lie over each other."""
        own = int(self.words[rows[0]])
        whole = self.flat[self.starts[rows][:, None] + np.arange(own)]
        return np.bitwise_xor.reduce(whole.reshape(len(rows), own // words, words), axis=1)

    def linkable(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs may link."""
        most = most_apart(self.sizes[i], self.sizes[j], self.percent)
        return self._within(i, j, most, most >= 0)

    def _within(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, fits: np.ndarray) -> np.ndarray:
        """Which of the pairs that ``fits`` marks differ in at most ``most`` bits."""
        passed = fits.copy()
        for sketches in (self.rough, self):
            if sketches is not None:
                at = np.flatnonzero(passed)
                passed[at] = sketches.apart(i[at], j[at]) <= most[at]
        return passed

    def forest(self, rows: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Pairs (parent, child) that tie the same ``rows`` together as all pairs that may link.

        Differences of sketches obey the triangle inequality, so rows at unlike distances from the first of their tree
        need no comparison of their own.
        """
        ends: tuple[list, list] = [], []
        left = rows[np.argsort(self.sizes[rows], kind="stable")]
        far = np.full(len(self.sizes), -1, np.int64)
        while len(left) > 1:
            first, left = left[:1], left[1:]
            around = left[: int(np.searchsorted(self.sizes[left] * self.percent**2, self.sizes[first[0]] * 10_000, "right"))]
            around = around[self.words[around] >= self.words[first[0]]]
            far[left], far[first] = -1, 0
            far[around] = self.apart(np.broadcast_to(first, around.shape), around)
            front = first
            while len(front) and len(left):
                turned = len(front) > len(left)
                few, many, grown = (left, front, []) if turned else (front, left, [])
                for x in few:
                    most = most_apart(self.sizes[x], self.sizes[many], self.percent)
                    fits = (most >= 0) & ((far[x] < 0) | (far[many] < 0) | (np.abs(far[many] - far[x]) <= most))
                    some = many[self._within(np.broadcast_to(x, many.shape), many, most, fits)]
                    if not len(some):
                        continue
                    if turned:
                        ends[0].append(some[:1])
                        some = np.array([x])
                    else:
                        ends[0].append(np.full(len(some), x))
                        many = np.setdiff1d(many, some, assume_unique=True)
                    ends[1].append(some)
                    grown.append(some)
                    if not len(many):
                        break
                front = np.concatenate(grown) if grown else front[:0]
                left = np.setdiff1d(left, front, assume_unique=True) if turned else many
            left = left[np.argsort(self.sizes[left], kind="stable")]
        return ends


def _digest(text: str | None) -> bytes | None:
    """Of the sequence of words; None without words."""
    words = b" ".join((text or "").encode("utf-8").lower().split())
    return xxhash.xxh3_128_digest(words) if words else None


def _chunks(batches: Iterator[pa.RecordBatch], size: int, name: bool = False) -> Iterator[tuple[list, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Runs of documents with about ``CHUNK_TOKENS`` shingles: (doc id, digest if asked for), their distinct shingles,
    and the distinct tokens of all with the number of documents of the run that hold each."""
    ids, sets, held = [], [], 0

    def done() -> tuple:
        flat = np.concatenate(sets) >> np.uint64(64 - TOKEN_BITS)
        return ids, sets, *np.unique(flat, return_counts=True)

    for part, found in parts_of(batches, size):
        texts = part.column("text").to_pylist() if name else [None] * len(part)
        ids += [(i, _digest(t)) for i, t in zip(part.column("doc_id").to_pylist(), texts)]
        sets += [np.unique(x) for x in found]
        held += sum(map(len, found))
        if held >= CHUNK_TOKENS:
            yield done()
            ids, sets, held = [], [], 0
    if ids:
        yield done()


def _chunk_name(chunk: int, tokens: np.ndarray) -> str:
    """Of the chunk's number and its tokens, so that an answer only serves the tokens that were asked for."""
    return f"{chunk:06d}-{xxhash.xxh3_128_hexdigest(tokens.tobytes())}"


def _answer_path(folder: str, task: int, chunk: str) -> tuple[pyarrow.fs.FileSystem, str]:
    store, root = pyarrow.fs.FileSystem.from_uri(folder)
    return store, f"{root}/task-{task:08d}-{chunk}"


def rarity(docs: DataFrame, size: int) -> tuple[str, np.ndarray]:
    """The folder of the answers for every chunk of ``docs`` (doc_id, text), and the table of counters."""
    bits = max(8, (plan_bytes(docs) // 4 // RANGE_TOKENS).bit_length()) if plan_bytes(docs) < 1 << 60 else 8
    bits = min(bits, 20)
    folder = shared_folder(docs.sparkSession, "shared-shingles")

    @released
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, total = TaskContext.get().partitionId(), np.zeros(COUNTERS, np.uint32)
        names = ["task", "chunk", "range", "data"]
        for chunk, (_, sets, tokens, _) in enumerate(_chunks(batches, size)):
            low = (tokens & np.uint64((1 << (TOKEN_BITS - bits)) - 1)).astype(np.uint32)
            cuts = np.searchsorted(tokens, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(TOKEN_BITS - bits))
            data = [x.tobytes() for x in np.split(low, cuts)]
            n = len(data)
            yield pa.RecordBatch.from_arrays([pa.array([task] * n, pa.int32()), pa.array([_chunk_name(chunk, tokens)] * n, pa.string()),
                                              pa.array(range(n), pa.int32()), pa.array(data, pa.binary())], names=names)
            flat = np.concatenate(sets)
            total += np.bincount((flat & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
        if total.any():  # counters go with the questions, under ranges of their own
            data = [zlib.compress(x.tobytes(), 1) for x in np.split(total, SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array([task] * SLICES, pa.int32()), pa.array([""] * SLICES, pa.string()),
                                              pa.array([-1 - k for k in range(SLICES)], pa.int32()), pa.array(data, pa.binary())], names=names)

    @released
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows, total = None, [], None

        def close() -> Iterator[pa.RecordBatch]:
            if place is None:
                return
            if place < 0:
                yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([""]), pa.array([place], pa.int32()), pa.array([total.astype(np.uint32).tobytes()], pa.binary())],
                                                 names=["task", "chunk", "range", "data"])
                return
            parts = [np.frombuffer(data, np.uint32) for _, _, data in rows]
            _, where, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            shared = np.split(counts[where] > 1, np.cumsum([len(x) for x in parts])[:-1])
            yield pa.RecordBatch.from_arrays([
                pa.array([t for t, _, _ in rows], pa.int32()), pa.array([c for _, c, _ in rows], pa.string()), pa.array([place] * len(rows), pa.int32()),
                pa.array([len(x).to_bytes(4, "little") + np.packbits(x).tobytes() for x in shared], pa.binary())], names=["task", "chunk", "range", "data"])

        for batch in batches:
            for task, chunk, range_, data in zip(*(batch.column(c).to_pylist() for c in ("task", "chunk", "range", "data"))):
                if range_ != place:
                    yield from close()
                    place, rows, total = range_, [], np.zeros(COUNTERS // SLICES, np.uint64)
                if range_ < 0:
                    total = np.minimum(total + np.frombuffer(zlib.decompress(data), np.uint32), np.uint64(2**32 - 1))
                else:
                    rows.append((task, chunk, data))
        yield from close()

    @released
    def deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts = None, []

        def close() -> None:
            if place is not None:
                store, path = _answer_path(folder, *place)
                store.create_dir(path.rpartition("/")[0], recursive=True)
                draft = f"{path}.{uuid.uuid4().hex}"
                with store.open_output_stream(draft) as file:
                    file.write(np.packbits(np.concatenate(parts)).tobytes())
                store.move(draft, path)

        for batch in batches:
            for task, chunk, data in zip(*(batch.column(c).to_pylist() for c in ("task", "chunk", "data"))):
                if (task, chunk) != place:
                    close()
                    place, parts = (task, chunk), []
                parts.append(np.unpackbits(np.frombuffer(data, np.uint8, offset=4))[: int.from_bytes(data[:4], "little")])
        close()
        yield from ()

    kind = "task int, chunk string, range int, data binary"
    reducers = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (1 << bits) // 64)
    asked = docs.mapInArrow(ask, kind).repartition(reducers, "range").sortWithinPartitions("range", "task", "chunk")
    answered = materialized(asked.mapInArrow(answer, kind), "shared-bits")
    sent = answered.where("task >= 0").repartition(reducers, "task").sortWithinPartitions("task", "chunk", "range")
    sent.mapInArrow(deliver, "task int").write.format("noop").mode("overwrite").save()
    table_ = np.zeros((SLICES, COUNTERS // SLICES), np.uint32)
    for row in answered.where("task < 0").select("range", "data").collect():
        table_[-1 - row["range"]] = np.frombuffer(row["data"], np.uint32)
    return folder, table_.ravel()


def _ordered(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Distinct shingles, rarest first."""
    own = np.unique(shingles)
    return own[np.argsort(counts[(own & np.uint64(COUNTERS - 1)).astype(np.int64)], kind="stable")]


def profiles(docs: DataFrame, answers: str, counts: Broadcast, size: int, percent: int) -> DataFrame:
    """(doc_id, digest, n, shared, prefix, sketch) of ``docs`` (doc_id, text): size of the set, how many of it are shared, those of
    them in its prefix, and the sketch of the set, null where the prefix has none."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for chunk, (ids, sets, tokens, held) in enumerate(_chunks(batches, size, name=True)):
            store, path = _answer_path(answers, task, _chunk_name(chunk, tokens))
            if store.get_file_info(path).type != pyarrow.fs.FileType.File:
                raise RuntimeError("the rows of a task changed between two passes over the input")
            with store.open_input_file(path) as file:
                bits = np.unpackbits(np.frombuffer(file.read(), np.uint8))
            shared = (bits[: len(tokens)] > 0) | (held > 1)
            flags = shared[np.searchsorted(tokens, np.concatenate(sets) >> np.uint64(64 - TOKEN_BITS))] if len(tokens) else shared
            prefixes, common_, sketches, at = [], [], [], 0
            for own in sets:
                mine = flags[at : at + len(own)]
                at += len(own)
                left = (prefix_length(len(own), percent) if len(own) else 0) - int((~mine).sum())
                common = own[mine]
                by = np.argsort(counts.value[(common & np.uint64(COUNTERS - 1)).astype(np.int64)], kind="stable")
                prefixes.append(common[by[: max(0, left)]])
                common_.append(len(common))
                sketches.append(sketch(own, percent) if len(prefixes[-1]) else None)
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in ids], pa.int64()), pa.array([d for _, d in ids], pa.binary()),
                pa.array([len(x) for x in sets], pa.int64()), pa.array(common_, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes).view(np.int64))), pa.array(sketches, pa.binary()),
            ], names=["doc_id", "digest", "n", "shared", "prefix", "sketch"])

    return docs.mapInArrow(run, "doc_id long, digest binary, n long, shared long, prefix array<long>, sketch binary")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of the sequence of words, null without words."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [_digest(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "digest"])

    return docs.mapInArrow(run, "doc_id long, digest binary")


def _meetings(profiled: DataFrame, percent: int) -> DataFrame:
    """(hub, class, digest, n): sets that hold a shingle of which the hub is the smallest holder, once each."""
    held = profiled.select(F.col("doc_id").alias("class"), "digest", "n", "shared", F.posexplode("prefix").alias("place", "shingle"))
    place = F.struct("class", "n", (F.col("shared") - F.col("place")).alias("rest"))  # of the set, from this shingle on
    held_by = held.groupBy(F.col("shingle").alias("own")).agg(F.count("*").alias("holders"), F.min(place).alias("least"), F.max(place).alias("most"))
    need = F.expr(f"({percent} * (least.n + most.n) + {99 + percent}) div {100 + percent}")
    # a linked pair passes the positional filter at its first common shingle
    met = held_by.where("least.class < most.class").where((F.col("holders") > 2) | (F.least("least.rest", "most.rest") >= need))
    found = held.join(met.select("own", F.col("least.class").alias("hub")), F.col("shingle") == F.col("own"))
    return found.select("hub", "class", "digest", "n").distinct()


def _split(members: DataFrame, hub: str, percent: int, finer: int = 1) -> DataFrame:
    """``members`` (``hub``, class, digest, n and others) with the number of parts of their hub, and their own part."""
    width = F.greatest(F.lit(32), F.col("n") * _scale(percent, finer) / 4)  # bytes, at most
    sizes = members.groupBy(F.col(hub).alias("split")).agg(F.count("*").alias("rows"), F.sum(width).alias("bytes"))
    sizes = sizes.select("split", F.greatest(F.ceil(F.col("rows") / HUB_ROWS), F.ceil(F.col("bytes") / HUB_BYTES)).cast("int").alias("parts"))
    large = cut_lineage(sizes.where("parts > 1"))
    placed = members.join(beside(large), F.col(hub) == F.col("split"), "left").drop("split").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return placed.withColumn("part", F.pmod(F.xxhash64("class"), "parts").cast("int"))


def _ties(sketched: DataFrame, percent: int, finer: int = 1) -> DataFrame:
    """(a, b): forests of classes that may link, for all of ``sketched`` (hub, parts, part, class, n, sketch) that share a hub."""
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), F.col("part")))
    dealt = sketched.select("*", F.explode(others).alias("other")).select(
        "hub", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "class", "n", "sketch")

    @released
    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole(batches, ["hub", "low", "high"]):
            a, b = _tied(rows, percent, finer)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    tasks = int(sketched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(tasks, "hub", "low", "high").sortWithinPartitions("hub", "low", "high")
    return dealt.mapInArrow(tie, "a long, b long")


def _candidates(profiled: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes tied by pairs that may link, by a forest for each hub."""
    placed = _split(cut_lineage(_meetings(profiled, percent)), "hub", percent)
    sketches = profiled.where("sketch IS NOT NULL").select(F.col("doc_id").alias("of"), F.col("digest").alias("words"), "sketch").dropDuplicates(["of", "words"])
    return _ties(placed.join(sketches, (F.col("class") == F.col("of")) & (F.col("digest") == F.col("words"))), percent)


def _edges(batch: pa.RecordBatch, key: list[str]) -> np.ndarray:
    """The first rows of runs of equal keys, but for that of the batch."""
    change = np.zeros(max(0, len(batch) - 1), bool)
    for c in key:
        values = batch.column(c).to_numpy()
        change |= values[1:] != values[:-1]
    return np.flatnonzero(change) + 1


def _whole(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``key``, so that rows of equal keys come in one piece."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        edges = _edges(batch, key)
        if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in key):
            yield pa.concat_batches(held)
            held = []
        if len(edges):
            yield pa.concat_batches([*held, batch.slice(0, int(edges[-1]))])
            held, batch = [], batch.slice(int(edges[-1]))
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def _tied(rows: pa.RecordBatch, percent: int, finer: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of classes for whole hubs: of few sets all that may link, of others a forest of these."""
    sketches = Sketches(rows.column("n").to_numpy(), rows.column("sketch"), percent, finer)
    starts = np.concatenate([[0], _edges(rows, ["hub", "low", "high"])])
    sizes = np.diff(np.append(starts, len(rows)))
    ends = np.repeat(starts + sizes, sizes)
    after = np.where(np.repeat(sizes, sizes) <= FEW, ends - np.arange(len(rows)) - 1, 0)
    i = np.repeat(np.arange(len(rows)), after)
    j = ranges(np.arange(len(rows)) + 1, after)
    passed = sketches.linkable(i, j)
    a, b = [i[passed]], [j[passed]]
    for k in np.flatnonzero(sizes > FEW):
        more = sketches.forest(np.arange(starts[k], starts[k] + sizes[k]))
        a += more[0]
        b += more[1]
    names = rows.column("class").to_numpy()
    return names[np.concatenate(a)], names[np.concatenate(b)]


def neighbourhoods(profiled: DataFrame, percent: int) -> DataFrame:
    """(class, hood, n) of classes that may link with another, through others as well."""
    hoods = components(_candidates(profiled, percent)).select(F.col("node").alias("class"), F.col("root").alias("hood"))
    sizes = profiled.groupBy(F.col("doc_id").alias("of")).agg(F.sum("n").alias("n"))
    return cut_lineage(hoods.join(sizes, F.col("class") == F.col("of")).select("class", "hood", "n"))


def _links(sets: list[np.ndarray], parts: np.ndarray, percent: int, trees: np.ndarray) -> np.ndarray:
    """Component of each set, as the index of one of its members; pairs within a part only count if there is one part.

    Sets of one of ``trees`` are known to be tied.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, local = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    cuts = np.zeros((m, PARTS), np.int64)
    np.add.at(cuts, (np.repeat(np.arange(m), sizes), local % PARTS), 1)
    prefixes = np.array([prefix_length(n, percent) for n in sizes])
    owner = np.repeat(np.arange(m), prefixes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(prefixes) - prefixes, prefixes)
    token = local[starts[owner] + place]
    by = np.lexsort((owner, token))
    owner, place, token = owner[by], place[by], token[by]
    first, last = np.searchsorted(token, local, "left"), np.searchsorted(token, local, "right")
    rank = np.empty(m, np.int64)
    rank[np.lexsort((np.arange(m), sizes))] = np.arange(m)
    cross = parts.min() != parts.max()
    _, firsts, tree = np.unique(trees, return_index=True, return_inverse=True)
    root = firsts[tree]
    held = np.zeros(int(local.max()) + 1, bool)
    for x in np.argsort(rank):
        at = np.arange(starts[x], starts[x] + prefixes[x])
        width = last[at] - first[at]
        mine = np.repeat(np.arange(prefixes[x]), width)
        entry = np.arange(len(mine)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first[at], width)
        y = owner[entry]
        fits = (rank[y] < rank[x]) & (root[y] != root[x]) & (100 * sizes[y] >= percent * sizes[x])
        if cross:
            fits &= parts[y] != parts[x]
        if not fits.any():
            continue
        entry, mine, y = entry[fits], mine[fits], y[fits]
        y, which = np.unique(y, return_index=True)  # the first common shingle of each pair
        need = least_overlap(sizes[y], sizes[x], percent)
        fits = np.minimum(sizes[x] - mine[which], sizes[y] - place[entry[which]]) >= need
        fits &= np.minimum(cuts[y], cuts[x]).sum(axis=1) >= need
        y, need = y[fits], need[fits]
        if not len(y):
            continue
        own = local[starts[x] : ends[x]]
        held[own] = True
        while len(y):
            some, need_some = y[:64], need[:64]
            inside = held[np.concatenate([local[starts[k] : ends[k]] for k in some])]
            overlap = np.add.reduceat(inside.astype(np.int64), np.cumsum(sizes[some]) - sizes[some])
            for k in some[overlap >= need_some]:
                if root[k] != root[x]:
                    root[root == root[k]] = root[x]
            y, need = y[64:], need[64:]
            still = root[y] != root[x]
            y, need = y[still], need[still]
        held[own] = False
    return root


def _parts(classes: str, shingles: str) -> Column:
    return F.greatest(F.ceil(F.col(classes) / CELL_CLASSES), F.ceil(F.col(shingles) / CELL_SHINGLES)).cast("int")


def _own_part(parts: str) -> Column:
    return F.pmod(F.xxhash64("class"), parts).cast("int")


def _trees(docs: DataFrame, members: DataFrame, counts: Broadcast, size: int, percent: int) -> DataFrame:
    """(a, b): edges of trees that tie linked classes."""
    hoods = members.groupBy(F.col("hood").alias("of")).agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"))
    members = cut_lineage(members.join(hoods.select("of", _parts("classes", "shingles").alias("parts")), F.col("hood") == F.col("of")).drop("of"))
    placed = members.where(F.col("parts") <= MOST_PARTS).select("class", "hood", _own_part("parts").alias("part"), F.col("parts").alias("cells"), F.col("class").alias("tree"))
    large = members.where(F.col("parts") > MOST_PARTS)
    if large.isEmpty():
        return _judged(docs, placed, counts, size, percent)
    rest, linked_ = _reduced(docs, large, size, percent)
    return _judged(docs, placed.union(rest), counts, size, percent).union(linked_)


def _reduced(docs: DataFrame, members: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """What remains of neighbourhoods (class, hood, n), for ``_judged``, and edges (a, b) of the linked classes found."""
    placed = cut_lineage(_split(members.select("class", F.col("hood").alias("hub"), "n"), "hub", percent, FINER).drop("n"))
    texts = docs.join(beside(placed), docs["doc_id"] == placed["class"]).select("hub", "parts", "part", "class", "text")

    @released
    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hub", "parts", "part", "class"]
        for part, found in parts_of(batches, size):
            sets = [np.unique(x) for x in found]
            own = pa.array([sketch(x, percent, FINER) for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array([len(x) for x in sets], pa.int64()), own], names=[*names, "n", "sketch"])

    sketched = texts.mapInArrow(sketches, "hub long, parts int, part int, class long, n long, sketch binary").where("n > 0")
    ties = cut_lineage(_ties(sketched, percent, FINER).where("a <> b").distinct())
    linked_ = _checked(docs, ties, size, percent)
    hoods = components(ties).select(F.col("node").alias("class"), F.col("root").alias("hood"))
    trees = components(linked_).select(F.col("node").alias("linked"), "root")
    known = hoods.join(trees, F.col("class") == F.col("linked"), "left").select("class", "hood", F.coalesce("root", "class").alias("tree"))
    known = cut_lineage(known.join(members.select(F.col("class").alias("of"), "n"), F.col("class") == F.col("of")).drop("of"))
    sizes = known.groupBy("hood", "tree").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"))
    cores = sizes.groupBy("hood").agg(F.max(F.struct("classes", "shingles", "tree")).alias("core"), F.sum("classes").alias("classes"), F.sum("shingles").alias("shingles"))
    cores = cores.where("classes > core.classes").select(
        F.col("hood").alias("of"), F.col("core.tree").alias("core"), _parts("core.classes", "core.shingles").alias("core_parts"),
        (F.col("classes") - F.col("core.classes")).alias("classes"), (F.col("shingles") - F.col("core.shingles")).alias("shingles"))
    cores = cores.withColumn("rest_parts", _parts("classes", "shingles"))
    # classes of the core meet those of the rest only
    inside = F.col("tree") == F.col("core")
    rest = known.join(cores, F.col("hood") == F.col("of")).select(
        "class", "hood", F.when(inside, F.col("rest_parts") + _own_part("core_parts")).otherwise(_own_part("rest_parts")).alias("part"),
        F.when(inside, F.col("rest_parts")).otherwise(F.col("rest_parts") + F.col("core_parts")).alias("cells"), "tree")
    return rest, linked_


def _checked(docs: DataFrame, ties: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of ``ties`` that are linked, of up to two for each b; the set of an a goes out once per ``CHILDREN`` of them."""
    picked = ties.groupBy(F.col("b").alias("class")).agg(F.min("a").alias("p"), F.max("a").alias("q"))
    picked = cut_lineage(picked.select("class", F.explode(F.array_distinct(F.array("p", "q"))).alias("key")))
    tasks = picked.groupBy("key").agg(F.ceil(F.count("*") / CHILDREN).cast("int").alias("salts"))
    children = picked.join(tasks, "key").select("class", F.struct("key", _own_part("salts").alias("salt"), F.lit(1).alias("child")).alias("place"))
    parents = tasks.select("key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    parents = parents.select(F.col("key").alias("class"), F.struct("key", "salt", F.lit(0).alias("child")).alias("place"))
    places = cut_lineage(children.union(parents).groupBy("class").agg(F.collect_list("place").alias("places")))
    texts = docs.join(beside(places, 1 << 18), docs["doc_id"] == places["class"]).select("class", "places", "text")

    @released
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in parts_of(batches, size):
            own = pa.array([np.unique(x).tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("class"), part.column("places"), own], names=["class", "places", "shingles"])

    @released
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parent = None, None
        for batch in batches:
            found = []
            for key, salt, child, class_, shingles in zip(*(batch.column(c).to_pylist() for c in ("key", "salt", "child", "class", "shingles"))):
                if place != (key, salt):
                    place, parent = (key, salt), None
                own = np.frombuffer(shingles, np.uint64)
                if not child:
                    parent = own if parent is None else parent  # one text of a doc_id will do: what is not found here is judged in a cell
                elif parent is not None:
                    common = len(np.intersect1d(parent, own, assume_unique=True))
                    if common and 100 * common >= percent * (len(parent) + len(own) - common):
                        found.append((key, class_))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    kind = places.schema["places"].dataType.simpleString()
    sent = texts.mapInArrow(sets, f"class long, places {kind}, shingles binary").select("class", F.explode("places").alias("place"), "shingles")
    sent = sent.select("place.key", "place.salt", "place.child", "class", "shingles")
    dealt = sent.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "salt").sortWithinPartitions("key", "salt", "child")
    return cut_lineage(dealt.mapInArrow(check, "a long, b long"))


def _judged(docs: DataFrame, placed: DataFrame, counts: Broadcast, size: int, percent: int) -> DataFrame:
    """(a, b): edges of trees in the cells of ``placed`` (class, hood, part, cells, tree): a class meets the parts below ``cells``."""
    placed = cut_lineage(placed)
    texts = docs.join(beside(placed), docs["doc_id"] == placed["class"]).select("class", "hood", "part", "cells", "tree", "text")

    names = ["class", "hood", "part", "cells", "tree"]

    @released
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in parts_of(batches, size):
            own = [_ordered(x, counts.value).tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(own, pa.binary())], names=[*names, "shingles"])

    @released
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            for *place, class_, part, tree, shingles in zip(*(batch.column(c).to_pylist() for c in ("hood", "low", "high", "class", "part", "tree", "shingles"))):
                if place != cell:
                    yield from judge(rows)
                    cell, rows = place, []
                rows.append((class_, part, np.frombuffer(shingles, np.uint64), tree))
        yield from judge(rows)

    def judge(rows: list) -> Iterator[pa.RecordBatch]:
        rows = [r for r in rows if len(r[2])]
        if len(rows) < 2:
            return
        names = np.array([r[0] for r in rows], np.int64)
        root = _links([r[2] for r in rows], np.array([r[1] for r in rows]), percent, np.array([r[3] for r in rows]))
        tied = np.flatnonzero(root != np.arange(len(rows)))
        yield pa.RecordBatch.from_arrays([pa.array(names[tied]), pa.array(names[root[tied]])], names=["a", "b"])

    shingled = texts.mapInArrow(sets, "class long, hood long, part int, cells int, tree long, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("other")
    dealt = shingled.select("*", other).select(
        "class", "hood", "part", "tree", "shingles", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(tasks, "hood", "low", "high").sortWithinPartitions("hood", "low", "high")
    return dealt.select("hood", "low", "high", "class", "part", "tree", "shingles").mapInArrow(cells, "a long, b long")


def _plain_scan(docs: DataFrame) -> bool:
    """Whether ``docs`` reads files row by row, so that every pass gives the same rows in the same order."""
    plan = docs._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.deterministic():
        plan = plan.children().head()
    return plan.nodeName().startswith("LogicalRelation") and bool(docs.inputFiles())


def linked(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not _plain_scan(docs):
        docs = materialized(docs, "documents")
    rows = materialized(digests(docs), "word-digests")
    known = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = cut_lineage(known.groupBy("digest").agg(F.min("doc_id").alias("class")))
    # a doc_id whose every row has the words of a smaller doc_id needs no set of its own
    named = known.join(classes.select(F.col("digest").alias("of"), "class"), F.col("digest") == F.col("of"))
    places = named.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.count("*").alias("rows"))
    places = cut_lineage(places)
    copies = cut_lineage(places.where("b < doc_id").select(F.col("doc_id").alias("copy_id")))
    first = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    small = copies.count() <= 1 << 20
    first = first.join(F.broadcast(copies) if small else copies, F.col("doc_id") == F.col("copy_id"), "left_anti")
    if not small:
        first = materialized(first, "first-documents")
    answers, table_ = rarity(first, size)
    counts = spark.sparkContext.broadcast(table_)
    profiled = materialized(profiles(first, answers, counts, size, percent), "shingle-prefixes")
    edges = _trees(first, neighbourhoods(profiled, percent), counts, size, percent)
    # rows that share a doc_id tie the classes of their texts
    several = places.where("a < b OR (a < doc_id AND rows > 1)").select("doc_id")
    tied = named.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("class").alias("b")).where("a <> b")
    roots = components(edges.union(tied))
    sizes = profiled.where("digest IS NOT NULL").groupBy(F.col("digest").alias("sized")).agg(F.max("n").alias("n"))
    final = classes.join(roots, F.col("class") == F.col("node"), "left").join(sizes, F.col("digest") == F.col("sized"), "left").select(
        F.col("digest").alias("of"), F.coalesce("root", "class").alias("component"), "n")
    found = rows.join(final, F.col("digest") == F.col("of"), "left")
    return found.select("doc_id", F.coalesce("n", F.lit(0)).alias("n_shingles"),
                        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def representatives(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The rows of ``docs``, all columns kept, without those that link to a document with a smaller doc_id.

    Rows with a null doc_id stay. Of rows that share a doc_id each text is judged by itself, in ascending order of
    (doc_id, SHA-256 of the text); of rows that share both, the smallest by its columns in their order stays.
    """
    known = docs.where("doc_id IS NOT NULL")
    if known.groupBy("doc_id").count().where("count > 1").isEmpty():
        found = linked(docs, size, percent)
        copies = cut_lineage(found.where("component_id <> doc_id").select(F.col("doc_id").alias("copy_id")).distinct())
        return docs.join(beside(copies), docs["doc_id"].cast("long") == copies["copy_id"], "left_anti")
    digest, row = _free("digest", docs), _free("row", docs)
    named = known.withColumn(digest, F.coalesce(F.sha2("text", 256), F.lit("")))
    # equal (doc_id, text) merge before the shuffle, however many there are
    single = named.groupBy(F.col("doc_id").alias("own_id"), F.col(digest).alias("own_digest")).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(row))
    single = materialized(single, "distinct-texts")
    numbered = materialized(dense_row_number(single.select("own_id", "own_digest"), ["own_id", "own_digest"], "number"), "numbered-texts")
    texts = single.join(numbered, ["own_id", "own_digest"]).select(F.col("number").alias("doc_id"), F.col(f"{row}.text").alias("text"))
    found = linked(texts, size, percent)
    stay = found.where("component_id = doc_id").select(F.col("doc_id").alias("number"))
    kept = single.join(numbered.join(stay, "number"), ["own_id", "own_digest"]).select(f"{row}.*")
    return kept.union(docs.where("doc_id IS NULL"))


def _free(name: str, df: DataFrame) -> str:
    """``name``, with as many underscores as it takes to clash with no column."""
    while name in df.columns:
        name += "_"
    return name


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return linked(table(spark, folder, "documents"), size=3, percent=90)


QUERIES = {"op9_jaccard": (op9_jaccard, None)}
