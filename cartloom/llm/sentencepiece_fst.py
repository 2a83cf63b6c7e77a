"""SentencePiece encoding and decoding with weighted transducers (operator 1).

A model file is compiled into three machines, which are composed with each input:

* the normaliser: dummy prefix, removal of extra whitespace where the model asks for it, space to U+2581;
* the lexicon: a trie of all pieces whose final states write the piece's id, with an arc for every character outside of
  it that writes the ids of its UTF-8 bytes (or the unknown id, once per run, in models without byte pieces);
* the grammar over ids. A unigram model has one state and the weight ``-score`` for each piece. In a byte-pair model
  the state is the piece read last, and the arc to the next piece weighs 0 if merging the text of both gives
  back these two pieces, and infinity otherwise. A sequence is what merging makes of a text exactly if all its
  neighbours are such pairs, so one path has a finite weight, and the tropical shortest path is that one.

Arcs of the grammar are computed when the search meets them: a pair is checked by undoing the merges of both pieces in
falling rank and asking at each step whether a merge over the border would have come first. Pieces that the
argument doesn't cover (several pieces of one score, such as runs of spaces, or pieces that merging doesn't build
from earlier ones) are marked when the model is compiled, and inputs whose lattice holds one are merged step by step.

Since no piece reaches over the place before a run of U+2581 that follows another character, nor, in many models, over
the place between an ASCII letter and a mark (both checked when the model is compiled), an input is cut there into
units: at each such run, and before a mark that ends a word. Each distinct unit is composed and searched once per worker
and kept, up to ``KEPT_BYTES``. All new units of a batch advance together, one character a step, in numpy.

Defined cases: a null text is an empty one and has no ids. Decoding gives back the text, except that U+2581 in
it comes back as a space. Rows of one doc_id are encoded one by one. Models with a character map or with
user-defined pieces are refused when they are loaded.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from cartloom.llm.common import released, slices, table
from cartloom.llm.units import MARKS, Memory, Rows, cut, marked

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the file format
UNIGRAM, BPE = 1, 2  # model types of the file format
NEVER = np.int64(1 << 40)
START = -1
SPACE_BYTES = SPACE.encode("utf-8")
KEPT_BYTES = 40 << 20
BETWEEN = 0xFF  # a byte that no text holds stands between texts
_BETWEEN_ONLY = np.arange(256) == BETWEEN
BLOCK_CHARS = 1 << 18


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffers message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else 4 if kind == 5 else 8
        yield key >> 3, data[at : at + size]
        at += size


class Table:
    """Integer keys to integer values with vectorised lookup: open addressing at a low load."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int) -> None:
        self.shift = np.uint64(64 - max(4, int(8 * len(keys) + 1).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values, self.missing = np.full(size + 64, -1, np.int64), np.full(size + 64, missing, np.int64), missing
        left, slots = np.arange(len(keys)), self._slots(keys)
        self.probes = 0
        while len(left):
            free = self.keys[slots] == -1
            _, first = np.unique(np.where(free, slots, -1 - np.arange(len(slots))), return_index=True)
            first = first[free[first]]
            self.keys[slots[first]], self.values[slots[first]] = keys[left[first]], values[left[first]]
            kept = np.ones(len(left), bool)
            kept[first] = False
            left, slots = left[kept], slots[kept] + 1
            self.probes += 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], self.missing)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            slots[open_] += 1
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


class Transducer:
    """A compiled model."""

    def __init__(self, path: str) -> None:
        pieces, self.model_type, prefix, trim, escape = [], UNIGRAM, True, True, True
        with open(path, "rb") as file:
            message = file.read()
        for field, value in _fields(message):
            if field == 1:
                own = dict(_fields(value))
                pieces.append((own[1].decode(), struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0], own.get(3, NORMAL)))
            elif field == 2:
                own = dict(_fields(value))
                self.model_type = own.get(3, UNIGRAM)
                if own.get(24, 0):
                    raise ValueError("models that put the space at the end of words are not supported")
            elif field == 3:
                own = dict(_fields(value))
                prefix, trim, escape = (bool(own.get(k, 1)) for k in (3, 4, 5))
                if own.get(2):
                    raise ValueError("models with a character map are not supported")
        if self.model_type not in (UNIGRAM, BPE) or any(t == USER_DEFINED for _, _, t in pieces) or not escape:
            raise ValueError("only unigram and byte-pair models without user-defined pieces are supported")
        self._compile(pieces, prefix, trim)

    @classmethod
    def of_pieces(cls, pieces: list[tuple[str, float, int]], model_type: int, prefix: bool = True, trim: bool = False) -> Transducer:
        made = cls.__new__(cls)
        made.model_type = model_type
        made._compile(pieces, prefix, trim)
        return made

    def _compile(self, pieces: list[tuple[str, float, int]], prefix: bool, trim: bool) -> None:
        self.prefix, self.trim = prefix, trim
        self.ids = {p: i for i, (p, _, t) in enumerate(pieces) if t == NORMAL}
        self.unknown = next((i for i, (_, _, t) in enumerate(pieces) if t == UNKNOWN), 0)
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.n = len(pieces)
        self.cost = np.array([-s for _, s, _ in pieces])
        self.texts = [b"" if t in (CONTROL, UNUSED) else bytes([int(p[1:-1], 16)]) if t == BYTE else " ⁇ ".encode()
                      if t == UNKNOWN else p.replace(SPACE, " ").encode() for p, _, t in pieces]
        self.longest = max(map(len, self.ids), default=1)
        self.cuttable = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.markable = self.cuttable and not any(re.search(f"[A-Za-z][{MARKS.decode()}]", p) for p in self.ids)
        self._trie()
        if self.model_type == BPE:
            self._grammar()
        self.memory, self.rows = Memory(KEPT_BYTES), Rows(np.uint32)

    def _trie(self) -> None:
        alphabet = sorted({c for p in self.ids for c in p})
        self.alphabet = np.array([ord(c) for c in alphabet] or [0], np.uint32)
        self.classes = len(alphabet) + 1
        of = {c: k + 1 for k, c in enumerate(alphabet)}
        children: dict[int, int] = {}
        final = [START]
        for piece, i in self.ids.items():
            node = 0
            for c in piece:
                key = node * self.classes + of[c]
                if key not in children:
                    children[key] = len(final)
                    final.append(START)
                node = children[key]
            final[node] = i
        self.final = np.array(final)
        self.arcs = Table(np.fromiter(children, np.int64, len(children)), np.fromiter(children.values(), np.int64, len(children)), -1)

    def _grammar(self) -> None:
        """Ranks, merge trees of the pieces, pairs that merge, and the pieces the pair check doesn't cover."""
        order = sorted((self.cost[i], i) for p, i in self.ids.items() if len(p) > 1)
        self.rank = np.full(self.n, -1, np.int64)
        self.left, self.right = np.full(self.n, -1, np.int64), np.full(self.n, -1, np.int64)
        self.odd = np.zeros(self.n, bool)
        for k, (cost, i) in enumerate(order):
            self.rank[i] = k
            self.odd[i] = (k > 0 and order[k - 1][0] == cost) or (k + 1 < len(order) and order[k + 1][0] == cost)
        pairs: dict[int, int] = {}
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                a, b = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a * self.n + b] = int(self.rank[i])
        self.pairs = Table(np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs)), NEVER)
        for piece, i in self.ids.items():
            if len(piece) > 1:
                *merged, last = self._merges(piece) or [None]
                whole = last is not None and last[2] == i
                self.odd[i] |= not whole or max(self.rank[last[0]], self.rank[last[1]]) >= self.rank[i]
                if whole:
                    self.left[i], self.right[i] = last[0], last[1]
        for _, i in order:  # what is built from an odd piece is odd
            if self.left[i] >= 0:
                self.odd[i] |= self.odd[self.left[i]] | self.odd[self.right[i]]

    def _merges(self, text: str, result: list | None = None) -> list[tuple[int, int, int]]:
        """The merges of ``text`` (all its characters are pieces), best score first, then leftmost, in order."""
        symbols: list[str | None] = list(text)
        before, after = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1))
        heap, done = [], []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < len(symbols):
                piece = self.ids.get(symbols[i] + symbols[j])
                if piece is not None:
                    heapq.heappush(heap, (self.cost[piece], i, symbols[i], symbols[j], piece))

        for i in range(len(symbols) - 1):
            offer(i)
        while heap:
            _, i, a, b, piece = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= len(symbols) or symbols[j] != b:
                continue
            done.append((self.ids[a], self.ids[b], piece))
            symbols[i], symbols[j] = a + b, None
            after[i] = after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        if result is not None:
            result.extend(self.ids[s] for s in symbols if s is not None)
        return done

    def _allowed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Weight 0 (True) or infinity (False) of the grammar's arcs from piece ``a`` to piece ``b``."""
        allowed = np.ones(len(a), bool)
        open_ = np.flatnonzero(a != START)
        x, y, limit = a[open_], b[open_], np.full(len(open_), NEVER)
        while len(open_):
            crossed = self.pairs.get(x * self.n + y) < limit
            allowed[open_[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            open_, x, y, rx, ry = open_[go], x[go], y[go], rx[go], ry[go]
            undo_x = rx > ry
            limit = np.where(undo_x, rx, ry + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return allowed

    def _search(self, segments: list[str]) -> list[list[int]]:
        """Shortest paths of segments whose characters are all known."""
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        classes = np.searchsorted(self.alphabet, codes) + 1
        sizes = np.array([len(s) for s in segments])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        limit = np.repeat(ends, sizes)
        n = len(codes)
        at, state = np.arange(n), np.zeros(n, np.int64)
        lattice = np.full((self.longest + 1, n + 1), START, np.int32)
        for size in range(1, self.longest + 1):
            state = self.arcs.get(state * self.classes + classes[at + size - 1])
            alive = state >= 0
            at, state = at[alive], state[alive]
            piece = self.final[state]
            hit = piece >= 0
            lattice[size, at[hit] + size] = piece[hit]
            more = at + size < limit[at]
            at, state = at[more], state[more]
            if not len(at):
                break
        last = np.full(n + 1, START, np.int64)
        step = np.zeros(n + 1, np.int64)
        odd = np.zeros(len(segments), bool)
        order = np.argsort(-sizes, kind="stable")
        first, count = starts[order], len(order)
        best = np.zeros(n + 1) if self.model_type == UNIGRAM else None
        for t in range(1, int(sizes.max(initial=0)) + 1):
            while count and sizes[order[count - 1]] < t:
                count -= 1
            here = first[:count] + t
            if best is not None:
                weight = np.full(count, np.inf)
                for size in range(1, min(t, self.longest) + 1):
                    piece = lattice[size, here]
                    from_ = best[here - size] if size < t else np.zeros(count)
                    total = np.where(piece >= 0, from_ + self.cost[piece], np.inf)
                    better = total < weight
                    weight[better] = total[better]
                    last[here[better]], step[here[better]] = piece[better], size
                best_here = weight
                best[here] = best_here
                continue
            open_ = np.arange(count)
            for size in range(min(t, self.longest), 0, -1):
                piece = lattice[size, here[open_]].astype(np.int64)
                some = np.flatnonzero(piece >= 0)
                if not len(some):
                    continue
                rows, piece = open_[some], piece[some]
                odd[order[rows]] |= self.odd[piece]
                from_ = last[here[rows] - size] if size < t else np.full(len(rows), START)
                fits = self._allowed(from_, piece)
                last[here[rows[fits]]], step[here[rows[fits]]] = piece[fits], size
                taken = np.zeros(len(open_), bool)
                taken[some[fits]] = True
                open_ = open_[~taken]
                if not len(open_):
                    break
            odd[order[open_]] = True
        found = []
        last_, step_ = last.tolist(), step.tolist()
        for k, segment in enumerate(segments):
            path: list[int] = []
            if odd[k]:
                self._merges(segment, path)
            else:
                i, start = int(ends[k]), int(starts[k])
                while i > start:
                    path.append(last_[i])
                    i -= step_[i]
                path.reverse()
            found.append(path)
        return found

    def _fallback(self, text: str) -> list[int]:
        if self.byte_ids:
            return [self.byte_ids[b] for b in text.encode("utf-8")]
        return [self.unknown]

    def _learn(self, units: list[str]) -> None:
        """Compose new units with the lexicon and the grammar, search, and add their ids."""
        if not hasattr(self, "segment"):
            inside = "".join(re.escape(chr(c)) for c in self.alphabet)
            self.segment = re.compile(f"([{inside}]+)")
        parts = [self.segment.split(unit) for unit in units]
        segments = list({s for part in parts for s in part[1::2]})
        paths: dict[str, list[int]] = {}
        i = 0
        while i < len(segments):
            j, held = i, 0
            while j < len(segments) and (j == i or held + len(segments[j]) <= BLOCK_CHARS):
                held += len(segments[j])
                j += 1
            for s, path in zip(segments[i:j], self._search(segments[i:j])):
                paths[s] = path
            i = j
        found = [[i for k, s in enumerate(part) if s for i in (paths[s] if k % 2 else self._fallback(s))] for part in parts]
        counts = np.array([*map(len, found)], np.int64)
        self.rows.add(np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum())), counts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, from the ids of its units."""
        if self.trim:
            texts = [re.sub(" +", " ", t).strip(" ") for t in texts]
        front = b" " if self.prefix else b""
        raw = [front + t.encode("utf-8").replace(SPACE_BYTES, b" ") if t else b"" for t in texts]
        data = np.frombuffer(bytes([BETWEEN]).join(raw), np.uint8)
        breaks = None
        if self.cuttable and len(data):
            breaks = (data == 32) & np.append(False, data[:-1] != 32)
            if self.markable:
                breaks |= marked(np.where(data == BETWEEN, np.uint8(32), data))
        index, units, starts = cut(data, _BETWEEN_ONLY, breaks)
        before = self.rows.n
        numbers, new = self.memory.place(units)
        if new:
            self._learn([u.decode("utf-8").replace(" ", SPACE) for u in new])
        flat, counts = self.rows.get(numbers[index])
        self.rows.cut_back(before + self.memory.settle(4 * self.rows.counts[before : self.rows.n]))
        places = np.cumsum([len(t) + 1 for t in raw])  # bytes, with the one between
        ends = np.append(0, np.cumsum(counts))[np.searchsorted(starts, places)]
        return np.split(flat, ends[:-1])

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.texts.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_TRANSDUCERS: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One compiled model per Python worker and file."""
    if path not in _TRANSDUCERS:
        _TRANSDUCERS[path] = Transducer(path)
    return _TRANSDUCERS[path]


def encode(docs: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``docs`` with all its columns and the ids of ``text`` as an array; a clashing name gets an underscore."""
    while ids in docs.columns:
        ids += "_"

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(model)
        for batch in batches:
            for part in slices(batch, most=2 << 20):
                found = own.encode([t or "" for t in part.column("text").to_pylist()])
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = np.concatenate(found).astype(np.int32) if len(found) else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, ids])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(ids, ArrayType(IntegerType()))]))


def encoded(docs: DataFrame, model: str, with_ids: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_tokens, crc32 of the ids, length and sha256 of what decoding gives back, ids."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(model)
        for batch in batches:
            for part in slices(batch, most=2 << 20):
                found = own.encode([t or "" for t in part.column("text").to_pylist()])
                texts = [own.decode(x) for x in found]
                columns = [
                    part.column("doc_id"), pa.array([len(x) for x in found], pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts]),
                ]
                if with_ids:
                    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = "doc_id long, n_tokens long, ids_crc32 long, decoded_chars long, decoded_sha256 string" + ", ids array<int>" * with_ids
    names = [field.split(" ")[0] for field in kind.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return encoded(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


QUERIES = {"op1_sentencepiece": (op1_sentencepiece, None)}
