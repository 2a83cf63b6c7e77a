"""Token ids in bit-packed binary files (operator 5).

File format, all integers little-endian: 8 bytes magic, then blocks, a footer and a fixed tail.

* A block holds ``BLOCK`` ids (the last one fewer), each in the same number of bits, lowest bit first.
* The footer holds the byte offset of every block (int64), then the doc ids (int64) and the number of ids of
  every document (int64), in ascending order of doc_id.
* The tail of 48 bytes holds as int64: bits per id, ids per block, ids, blocks, documents, offset of the footer.

One file holds one range of doc ids, so the files in ascending order of shard hold all documents in order. Any
id is found by one division and one seek, and a block is unpacked by a few numpy operations.

Defined cases: a null text is an empty one; every document, also an empty one, gets the end id; repeated doc ids
follow each other, ordered by their ids; null doc ids come first. An empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import plan_bytes, shared_folder, slices, table
from cartloom.llm.shingles import run_hashes
from cartloom.session import cut_lineage

MAGIC = b"idblock1"
BLOCK = 1 << 16
TAIL = 48
SHARD_BYTES = 12 << 20
CACHED_UNITS = 1_000_000
JOINED_UNITS = 2000
NO_ID = -(1 << 63)  # a null doc id in a file


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    raw = ids.astype("<u8").view(np.uint8).reshape(-1, 8)
    spread = np.unpackbits(raw, axis=1, bitorder="little")[:, :bits]
    return np.packbits(spread.ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """``count`` ids of up to 32 bits from packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    at = np.arange(count, dtype=np.int64) * bits
    first, shift = at >> 3, (at & 7).astype(np.uint64)
    word = np.zeros(count, np.uint64)
    for k in range((bits + 14) // 8):
        word |= padded[first + k].astype(np.uint64) << np.uint64(8 * k)
    return ((word >> shift) & np.uint64((1 << bits) - 1)).astype("<u4")


class ShardWriter:
    """Streams the documents of one shard; the file appears under its name only when it is whole."""

    def __init__(self, folder: str, name: str, bits: int) -> None:
        self.store, root = pyarrow.fs.FileSystem.from_uri(folder)
        self.store.create_dir(root, recursive=True)
        self.path, self.draft = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.draft)
        self.out.write(MAGIC)
        self.bits, self.at = bits, len(MAGIC)
        self.offsets: list[int] = []
        self.doc_ids: list[int] = []
        self.counts: list[int] = []
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(NO_ID if doc_id is None else doc_id)
        self.counts.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK:
            ready = np.concatenate(self.held)
            whole = len(ready) // BLOCK * BLOCK
            for i in range(0, whole, BLOCK):
                self._block(ready[i : i + BLOCK])
            self.held, self.n_held = [ready[whole:]], len(ready) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.offsets.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def close(self) -> int:
        rest = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        if len(rest):
            self._block(rest)
        total = int(sum(self.counts))
        for part in (self.offsets, self.doc_ids, self.counts):
            self.out.write(np.asarray(part, "<i8").tobytes())
        tail = [self.bits, BLOCK, total, len(self.offsets), len(self.doc_ids), self.at]
        self.out.write(np.asarray(tail, "<i8").tobytes())
        self.out.close()
        self.store.move(self.draft, self.path)
        return total


class ShardReader:
    """Random access to a shard."""

    def __init__(self, folder: str, name: str) -> None:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        self.file = store.open_input_file(f"{root}/{name}")
        size = self.file.size()
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{root}/{name} holds no token ids")
        tail = np.frombuffer(self.file.read_at(TAIL, size - TAIL), "<i8")
        self.bits, self.block, self.total, blocks, docs, self.footer = (int(x) for x in tail)
        numbers = np.frombuffer(self.file.read_at(8 * (blocks + 2 * docs), self.footer), "<i8")
        self.offsets, self.doc_ids, self.counts = np.split(numbers, [blocks, blocks + docs])
        self.starts = np.cumsum(self.counts) - self.counts

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` of the shard; only their blocks are read."""
        parts = []
        for k in range(start // self.block, -(-(start + count) // self.block)):
            held = min(self.block, self.total - k * self.block)
            end = int(self.offsets[k + 1]) if k + 1 < len(self.offsets) else self.footer
            block = unpack(self.file.read_at(end - int(self.offsets[k]), int(self.offsets[k])), self.bits, held)
            parts.append(block[max(0, start - k * self.block) : start + count - k * self.block])
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the shard, ids), in order, about a million ids at a time."""
        i = 0
        while i < len(self.counts):
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + (1 << 20))))
            ids = self.ids(int(self.starts[i]), int(self.counts[i:j].sum()))
            for k in range(i, j):
                at = int(self.starts[k] - self.starts[i])
                doc_id = int(self.doc_ids[k])
                yield None if doc_id == NO_ID else doc_id, int(self.starts[k]), ids[at : at + int(self.counts[k])]
            i = j


class Encoder:
    """Ids of whole texts by the tokenizers library, which is asked once for each distinct unit.

    The byte-level pre-tokenizer always starts a new token at a single space that stands between two non-space
    characters, and tokens never reach over that place, so texts are cut there. Units are hashed in numpy (64 bits, and
    the length is compared), looked up together, and their ids copied together. New units without other spaces are
    encoded many at a time: each token that begins with a space starts the next unit. Once ``CACHED_UNITS`` are
    known, further ones are encoded again in each slice; the units met first are the frequent ones.
    Texts with other white space next to a space, or with special tokens, are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.blanks = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.space = np.arange(256) == 32
        self.known: dict[int, int] = {}
        self.places = np.zeros((3, 1 << 16), np.int64)  # first id in the store, number of ids, bytes of the unit
        self.store = np.zeros(1 << 20, np.uint32)
        self.held = 0

    def _plain(self, text: str) -> bool:
        if not text or text[0].isspace() or text[-1].isspace() or "  " in text or " \n" in text or "\n " in text:
            return False
        return not any(c in text for c in self.blanks) and not any(s in text for s in self.special)

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Ids of units, how many each has, and the order in which they come: first those that are encoded jointly."""
        joint, rest = [], []
        for k, unit in enumerate(units):
            (joint if unit[0] == " " and unit.count(" ") == 1 else rest).append(k)
        texts = ["".join([units[k] for k in joint[i : i + JOINED_UNITS]]) for i in range(0, len(joint), JOINED_UNITS)]
        texts += [units[k] for k in rest]
        parts = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = []
        for i, ids in enumerate(parts):
            if i * JOINED_UNITS < len(joint):
                starts = np.flatnonzero(self.opens[ids])
                if len(starts) != len(joint[i * JOINED_UNITS : (i + 1) * JOINED_UNITS]) or starts[0]:
                    raise ValueError("a unit doesn't start with exactly one token that holds a space")
                counts.append(np.diff(np.append(starts, len(ids))))
            else:
                counts.append(np.array([len(ids)]))
        return np.concatenate(parts), np.concatenate(counts), joint + rest

    def _learn(self, names: np.ndarray, units: list[str], sizes: np.ndarray) -> None:
        flat, counts, order = self._encode(units)
        while self.held + len(flat) > len(self.store):
            self.store = np.append(self.store, np.zeros_like(self.store))
        while len(self.known) + len(units) > self.places.shape[1]:
            self.places = np.append(self.places, np.zeros_like(self.places), axis=1)
        first = len(self.known)
        self.places[:, first : first + len(units)] = self.held + np.cumsum(counts) - counts, counts, sizes[order]
        self.store[self.held : self.held + len(flat)] = flat
        self.held += len(flat)
        self.known.update(zip(names[order].tolist(), range(first, first + len(units))))

    def _joint_ids(self, texts: list[str]) -> list[np.ndarray]:
        raw = [t.encode("utf-8") for t in texts]
        data = b" ".join(raw)
        starts, sizes, hashes = run_hashes(np.frombuffer(data, np.uint8), self.space)
        words = np.array([t.count(b" ") + 1 for t in raw])
        heads = np.cumsum(words) - words
        hashes[heads] = hashes[heads] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)  # no space in front
        own, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        names = own.tolist()
        index = [*map(self.known.get, names)]
        new = [k for k, i in enumerate(index) if i is None]
        before, held = len(self.known), self.held
        if new:
            at_head = np.isin(first[new], heads).tolist()
            places = [(int(starts[first[k]]), int(starts[first[k]] + sizes[first[k]])) for k in new]
            units = [("" if head else " ") + data[a:b].decode("utf-8") for head, (a, b) in zip(at_head, places)]
            self._learn(own[new], units, sizes[first[new]])
            for k in new:
                index[k] = self.known[names[k]]
        begin, count, length = (x[inverse] for x in self.places[:, np.array(index)])
        if (length != sizes).any():
            raise ValueError("two units have the same hash")
        ends = np.cumsum(count)
        ids = self.store[np.arange(ends[-1]) + np.repeat(begin - (ends - count), count)]
        if before > CACHED_UNITS:
            for k in new:
                del self.known[names[k]]
            self.held = held
        return np.split(ids, ends[np.cumsum(words) - 1][:-1])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self._plain(t) for t in texts]
        joint = iter(self._joint_ids([t for t, p in zip(texts, plain) if p]) if any(plain) else [])
        rest = iter(self.tokenizer.encode_batch_fast([t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        return [next(joint) if p else np.array(next(rest).ids, np.uint32) for p in plain]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards in ``folder``; one row per shard: shard, name, n_ids, start.

    Ranges of doc ids follow quantiles of all ids; each shard is written by one task in one stream, as a draft
    that is renamed when whole, so a repeated task writes the same file again.
    """
    from tokenizers import Tokenizer

    bits = bits_for(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True))
    rows, size = docs.count(), plan_bytes(docs.select("doc_id", "text"))
    size = size if size < 1 << 60 else rows * 4096  # a source that doesn't know its size
    shards = max(1, min(rows, -(-size // shard_bytes)))
    cuts = docs.select(F.percentile_approx("doc_id", [i / shards for i in range(1, shards)] or [0.5], 10_000)).first()[0]
    bounds = np.array(sorted(set(cuts or [])), np.int64) if shards > 1 else np.zeros(0, np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids = own.ids([t or "" for t in part.column("text").to_pylist()])
                doc_ids = part.column("doc_id").to_pylist()
                end = np.array([end_id], np.uint32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([0 if d is None else int(np.searchsorted(bounds, d)) for d in doc_ids], pa.int32()),
                    part.column("doc_id").cast(pa.int64()),
                    pa.array([len(x) + 1 for x in ids], pa.int64()),
                    pa.array([pack(np.concatenate([x, end]), bits) for x in ids], pa.binary()),
                ], names=["shard", "doc_id", "n_ids", "packed"])

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, shard = None, None
        for batch in batches:
            for s, doc_id, n, packed in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "n_ids", "packed"))):
                if writer is None:
                    writer, shard = ShardWriter(folder, f"shard-{s:08d}.ids", bits), s
                writer.add(doc_id, unpack(packed, bits, n))
        if writer is not None:
            total = writer.close()
            yield pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([f"shard-{shard:08d}.ids"]), pa.array([total], pa.int64()),
            ], names=["shard", "name", "n_ids"])

    encoded = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encode, "shard int, doc_id long, n_ids long, packed binary")
    placed = encoded.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("doc_id", "packed")
    files = cut_lineage(placed.mapInArrow(store, "shard int, name string, n_ids long"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(files: DataFrame, folder: str) -> DataFrame:
    """One row per document of the shards: doc_id, start, n_tokens, ids_crc32; ids come from the files."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                rows = [(doc_id, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for doc_id, at, ids in ShardReader(folder, name).documents()]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = max(1, files.count())
    return files.repartitionById(shards, F.col("shard") % shards).mapInArrow(
        load, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    out = shared_folder(spark, "token-ids")
    docs = table(spark, folder, "documents")
    return read(write(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, folder=out), out)


QUERIES = {"op5_token_files": (op5_token_files, None)}
