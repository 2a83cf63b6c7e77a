"""Sequences of fixed capacity from whole corpora by multiway differencing (operator 12).

The documents of an input partition are encoded in order and gathered into blocks of about ``BLOCK_WINDOWS`` windows.
Full windows of a long document are sequences of their own; what remains of it is one piece. The pieces of a block
are dealt to its windows by Karmarkar and Karp's multiway differencing: every piece starts as a partial partition with
one filled window, and the two partial partitions of largest imbalance are merged, the fullest window of one with
the emptiest of the other, until one is left. Its windows are nearly equal. If one of them exceeds the capacity,
the window count rises by one and the differencing is repeated.

Two things keep the padding small. A twentieth of a block's tokens is cut into short pieces, which the differencing
places last and which level the windows to a few tokens; blocks whose pieces don't fit that way (documents that
all fill a little over half a window, say) are cut finer, step by step, before the count rises. And the tokens that
would fill part of one more window only are taken from the end of the block as sequences whose lengths are powers of
two, which need no padding.

No row is shuffled and nothing is gathered beyond one block and one document. Sequence ids are the number of the
partition times 2^33 plus a running number. ``docs`` should be a stored table, as the rows of a repeated task then come
in the same order.

Defined cases: a null text is an empty one and has the end id only; rows of one doc_id are packed one by one, each
with its own ``start`` and ``doc_tokens``; a null doc_id stays null; an empty table gives no rows. Long texts are encoded
in parts, cut at spaces, which no token covers. Other columns are not carried.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from itertools import cycle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import slices, table
from cartloom.llm.units import Memory, Rows, cut, per_text, ranges, within

CAPACITY = 4096
BLOCK_WINDOWS = 128
SLACK = 6  # tokens by which windows stay below the capacity on average
SHORT = (64, 16, 4)
CUTS = ((CAPACITY, 0.05), (1024, 0.1), (512, 0.25), (128, 0.25), (64, 1.0))  # longest piece, share cut into short ones
TAIL_UNIT = 64
PART_BYTES = 4 << 20
JOINED_WORDS = 1000
BLANK, LETTER, MARK, CAPITAL = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (
    b" \t\n\r", b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
KEPT_BYTES = 64 << 20


class Encoder:
    """Ids of texts by the tokenizers library, asked once for each distinct unit.

    For a tokenizer that lower-cases, whose pre-tokenizer removes white space and takes letters, digits and other
    characters apart, and whose special tokens hold no space: units end at white space, and a mark between an ASCII
    letter and white space is one of its own. Capitals that no combining character can follow are lowered before.
    """

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(" " in t.content or t.lstrip or t.rstrip for t in added):
            raise ValueError("special tokens that reach over spaces are not supported")
        self.special = [t.content.encode("utf-8") for t in added]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.closes = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.end = np.array([end_id], np.uint32)
        self.memory, self.rows = Memory(KEPT_BYTES), Rows(np.uint32)

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, how many each has); words are encoded many at a time, as each ends with the next closing token."""
        words = [k for k, unit in enumerate(units) if unit.isalpha()]
        joint = [words[i : i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        texts = [" ".join([units[k] for k in part]) for part in joint]
        found: list[np.ndarray | None] = [None] * len(units)
        for part, own in zip(joint, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(own.ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(part):
                for k, a, b in zip(part, [0, *ends.tolist()], ends.tolist()):
                    found[k] = ids[a:b]
        rest = [k for k, ids in enumerate(found) if ids is None]
        for k, own in zip(rest, self.tokenizer.encode_batch_fast([units[k] for k in rest], add_special_tokens=False)):
            found[k] = np.array(own.ids, np.uint32)
        return np.concatenate(found), np.array([*map(len, found)], np.int64)

    def _part(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, how many each has)."""
        data = b" ".join(texts)
        raw = np.frombuffer(data, np.uint8)
        after = np.append(raw[1:], 32) if len(raw) else raw
        low = data.lower()
        if all(data.count(s) == low.count(s) for s in self.special):
            raw = raw + 32 * (CAPITAL[raw] & (after < 128)).astype(np.uint8)
        breaks = MARK[raw] & BLANK[after]
        breaks[1:] &= LETTER[raw[:-1]]
        units, distinct, starts = cut(raw, BLANK, breaks)
        before = self.rows.n
        numbers, new = self.memory.place(distinct)
        if new:
            self.rows.add(*self._encode([u.decode("utf-8") for u in new]))
        flat, counts = self.rows.get(numbers[units])
        self.rows.cut_back(before + self.memory.settle(4 * self.rows.counts[before : self.rows.n]))
        ends = np.append(0, np.cumsum(counts))
        return flat, np.diff(ends[np.cumsum(per_text(texts, starts))], prepend=0)

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text with the end id."""
        raw = [(t or "").encode("utf-8") for t in texts]
        parts = [p for t in raw for p in within(t, PART_BYTES)] if max(map(len, raw), default=0) > PART_BYTES else raw
        owners = np.repeat(np.arange(len(raw)), [len(within(t, PART_BYTES)) if len(t) > PART_BYTES else 1 for t in raw])
        found: list[list[np.ndarray]] = [[] for _ in raw]
        i = 0
        while i < len(parts):
            j, held = i, 0
            while j < len(parts) and (j == i or held + len(parts[j]) <= PART_BYTES):
                held += len(parts[j])
                j += 1
            flat, counts = self._part(parts[i:j])
            for owner, ids in zip(owners[i:j], np.split(flat, np.cumsum(counts)[:-1])):
                found[owner].append(ids)
            i = j
        return [np.concatenate([*x, self.end]) for x in found]


def differenced(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of every piece, length of every window) by Karmarkar and Karp's multiway differencing.

    A partial partition holds its windows' lengths less the smallest of them, in falling order. Merging pairs them in
    opposite order; the order in which the merged windows stand is kept, and read backwards it tells where pieces went.
    """
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(windows, np.int64)
    heap, merges = [], []
    for i, size in enumerate(sizes.tolist()):
        lengths = np.zeros(windows, np.int64)
        lengths[0] = size
        heap.append((-size if windows > 1 else 0, i, lengths))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        merged = left + right[::-1]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        merged -= merged[-1]
        merges.append((a, b, order.astype(np.int32)))
        heapq.heappush(heap, (-int(merged[0]), len(sizes) + len(merges) - 1, merged))
    places: dict[int, np.ndarray] = {heap[0][1]: np.arange(windows)}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        unsorted = np.empty(windows, np.int64)
        unsorted[order] = places.pop(len(sizes) + k)
        places[a], places[b] = unsorted, unsorted[::-1]
    window = np.array([places[i][0] for i in range(len(sizes))])
    return window, np.bincount(window, sizes, windows).astype(np.int64)


def _chopped(sizes: np.ndarray, longest: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, start in it, length) of pieces: the last items, up to ``share`` of all tokens, in short pieces, others in ``longest``."""
    left = np.cumsum(sizes[::-1])[::-1]  # tokens from an item to the end
    pieces = []
    for i, size in enumerate(sizes.tolist()):
        steps = cycle(SHORT) if left[i] <= share * left[0] or share >= 1 else cycle((longest,))
        at = 0
        while at < size:
            step = min(next(steps), size - at)
            pieces.append((i, at, step))
            at += step
    return tuple(np.array(c, np.int64) for c in zip(*pieces)) if pieces else (np.zeros(0, np.int64),) * 3


def plan(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(item, start, length, sequence) of the pieces of one block; items of at most ``capacity`` tokens, pieces of a sequence in order."""
    total = int(sizes.sum())
    windows = total // (capacity - SLACK)
    tail = total - windows * (capacity - SLACK)
    if windows:
        tail = -(-tail // TAIL_UNIT) * TAIL_UNIT
    while True:
        before = np.cumsum(sizes) - sizes
        main = np.clip(total - tail - before, 0, sizes)  # tokens of each item that are not in the tail
        for longest, share in CUTS:
            item, start, length = _chopped(main, min(longest, capacity), share)
            window, filled = differenced(length, max(windows, 1))
            if filled.max(initial=0) <= capacity:
                break
        else:
            windows, tail = windows + 1, 0
            continue
        break
    own = [(item, start, length, window)]
    sequence = int(window.max(initial=-1)) + 1
    i = int(np.argmax(main < sizes)) if tail else len(sizes)
    at = int(main[i]) if tail else 0
    rest = tail
    while rest:
        room = 1 << (rest.bit_length() - 1)
        room = min(room, 1 << (capacity.bit_length() - 1))
        rest -= room
        while room:
            step = min(room, int(sizes[i]) - at)
            if step:
                own.append(tuple(np.array([x]) for x in (i, at, step, sequence)))
            at, room = at + step, room - step
            if at == sizes[i]:
                i, at = i + 1, 0
        sequence += 1
    item, start, length, window = (np.concatenate(c) for c in zip(*own))
    order = np.lexsort((start, item, window))
    item, start, length, window = (x[order] for x in (item, start, length, window))
    opens = (np.diff(item, prepend=-1) != 0) | (np.diff(window, prepend=-1) != 0) | (start != np.roll(start + length, 1))
    first = np.flatnonzero(opens)  # neighbours of one document that meet again are one piece
    return item[first], start[first], np.add.reduceat(length, first) if len(first) else length, window[first]


class _Block:
    """Documents that wait for their windows."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.next = capacity, first
        self.doc_ids: list[int | None] = []
        self.rests: list[np.ndarray] = []
        self.starts: list[int] = []
        self.totals: list[int] = []
        self.tokens = 0

    def _batch(self, doc_ids: list, start: np.ndarray, length: np.ndarray, totals: list[int], sequence: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        """A batch of pieces, in the order of their sequences; ``ids`` are theirs one after the other."""
        before = np.cumsum(length) - length
        first = np.concatenate([[True], sequence[1:] != sequence[:-1]])
        offset = before - before[first][np.cumsum(first) - 1]
        ends = np.append(0, np.cumsum(4 * length)).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u4"))])
        return pa.RecordBatch.from_arrays([
            pa.array(doc_ids, pa.int64()), pa.array(start), pa.array(length), pa.array(totals, pa.int64()),
            pa.array(sequence), pa.array(offset), packed], names=NAMES)

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        whole = len(ids) // self.capacity
        for k in range(0, whole, 256):
            n = min(256, whole - k)
            start = (k + np.arange(n)) * self.capacity
            yield self._batch([doc_id] * n, start, np.full(n, self.capacity), [len(ids)] * n, self.next + np.arange(n),
                              ids[k * self.capacity : (k + n) * self.capacity])
            self.next += n
        rest = ids[whole * self.capacity :]
        if len(rest):
            self.doc_ids.append(doc_id)
            self.rests.append(rest.copy())
            self.starts.append(whole * self.capacity)
            self.totals.append(len(ids))
            self.tokens += len(rest)
            if self.tokens >= BLOCK_WINDOWS * self.capacity:
                yield self.close()

    def close(self) -> pa.RecordBatch:
        sizes = np.array([*map(len, self.rests)], np.int64)
        item, start, length, window = plan(sizes, self.capacity)
        flat = np.concatenate(self.rests)
        ids = flat[ranges((np.cumsum(sizes) - sizes)[item] + start, length)]
        own = item.tolist()
        batch = self._batch([self.doc_ids[i] for i in own], np.array(self.starts, np.int64)[item] + start, length,
                            [self.totals[i] for i in own], self.next + window, ids)
        self.next += int(window[-1]) + 1
        self.doc_ids, self.rests, self.starts, self.totals, self.tokens = [], [], [], [], 0
        return batch


SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
NAMES = [field.split(" ")[0] for field in SCHEMA.split(", ")]
_ENCODERS: dict[tuple[str, int], Encoder] = {}


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of the sequences that hold all tokens of ``docs`` (doc_id, text): :data:`SCHEMA`, ids as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (tokenizer, end_id) not in _ENCODERS:
            _ENCODERS[tokenizer, end_id] = Encoder(tokenizer, end_id)
        encoder = _ENCODERS[tokenizer, end_id]
        block = _Block(capacity, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for part in slices(batch):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.ids(part.column("text").to_pylist())):
                    yield from block.add(doc_id, ids)
        if block.tokens:
            yield block.close()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    packed = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op12_packing": (op12_packing, None)}
