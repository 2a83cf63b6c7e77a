"""Texts as sequences of distinct units, what a worker keeps about units, and chunk files in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs

SPACE_ONLY = np.arange(256) == 32
MARKS = b".,;:!?"
_MARK = np.isin(np.arange(256), list(MARKS))
_LETTER = np.isin(np.arange(256) & 0xDF, np.arange(65, 91)) & (np.arange(256) < 128)


def marked(raw: np.ndarray) -> np.ndarray:
    """Where a mark of ``MARKS`` stands between an ASCII letter and a space or the end."""
    found = _MARK[raw] & np.append(raw[1:] == 32, True) if len(raw) else np.zeros(0, bool)
    found[1:] &= _LETTER[raw[:-1]]
    found[:1] = False
    return found


def cut(raw: np.ndarray, blank: np.ndarray = SPACE_ONLY, breaks: np.ndarray | None = None) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(unit of every occurrence in order, distinct units, first byte of every occurrence) of the bytes ``raw``.

    Units are runs of bytes that are not ``blank`` (a table of 256), compared exactly; a run starts anew where ``breaks``.
    """
    solid = ~blank[raw]
    opens = solid & ~np.append(False, solid[:-1])
    if breaks is not None:
        opens |= solid & breaks
    starts = np.flatnonzero(opens)
    offsets = np.append(np.flatnonzero(opens[solid]), np.count_nonzero(solid)).astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[solid])])
    coded = runs.dictionary_encode()
    return coded.indices.to_numpy(), strings(coded.dictionary), starts


def strings(array: pa.BinaryArray) -> list[bytes]:
    """The values of an unsliced binary array without nulls, faster than one scalar each."""
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int32, len(array) + 1).tolist()
    whole = data.to_pybytes() if data else b""
    return [whole[a:b] for a, b in zip(ends, ends[1:])]


def per_text(texts: list[bytes], starts: np.ndarray) -> np.ndarray:
    """How many of the occurrences that :func:`cut` found each text holds."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.diff(np.searchsorted(starts, ends), prepend=0)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + count - 1`` of every pair, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def within(text: bytes, most: int) -> list[bytes]:
    """``text`` cut at spaces (which are dropped) into parts of about ``most`` bytes; a longer unit is one part."""
    parts, start = [], 0
    while len(text) - start > most:
        at = text.rfind(b" ", start, start + most)
        at = text.find(b" ", start + most) if at <= start else at
        if at < 0:
            break
        parts.append(text[start:at])
        start = at + 1
    return [*parts, text[start:]]


class Memory:
    """Numbers of units, up to a bound in bytes; units met first are the frequent ones and stay.

    ``place`` gives a number to every unit of a slice. Those above the bound hold for this slice only: once it is done
    with it, the owner calls ``settle`` and cuts its own store back to the units that stay.
    """

    ENTRY_BYTES = 160

    def __init__(self, most_bytes: int) -> None:
        self.numbers: dict[bytes, int] = {}
        self.most, self.held, self.fresh = most_bytes, 0, []

    def place(self, units: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """(number of every unit, the units that are new, in ascending order of their numbers)."""
        found = list(map(self.numbers.get, units))
        unknown = [k for k, number in enumerate(found) if number is None]
        self.fresh = [units[k] for k in unknown]
        first = len(self.numbers)
        self.numbers.update(zip(self.fresh, range(first, first + len(unknown))))
        for number, k in enumerate(unknown, first):
            found[k] = number
        return np.array(found, np.int64), self.fresh

    def settle(self, sizes: np.ndarray) -> int:
        """Keep the first of the fresh units, whose data take ``sizes`` bytes each, as far as the bound goes; says how many."""
        if not self.fresh:
            return 0
        held = self.held + np.cumsum(sizes + self.ENTRY_BYTES + np.array([*map(len, self.fresh)]))
        kept = int(np.searchsorted(held, self.most, "right"))
        for unit in self.fresh[kept:]:
            del self.numbers[unit]
        self.held = int(held[kept - 1]) if kept else self.held
        self.fresh = []
        return kept


class Rows:
    """Growing store of one array per unit."""

    def __init__(self, kind: type) -> None:
        self.flat, self.used = np.zeros(1 << 16, kind), 0
        self.starts, self.counts, self.n = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(counts) > len(self.counts):
            self.starts, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.counts))
        self.flat[self.used : self.used + len(flat)] = flat
        self.counts[self.n : self.n + len(counts)] = counts
        self.starts[self.n : self.n + len(counts)] = self.used + np.cumsum(counts) - counts
        self.used += len(flat)
        self.n += len(counts)

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(arrays of ``numbers`` one after the other, how long each is)."""
        counts = self.counts[numbers]
        return self.flat[ranges(self.starts[numbers], counts)], counts

    def cut_back(self, n: int) -> None:
        """Keep the first ``n`` arrays."""
        self.n, self.used = n, int(self.starts[n - 1] + self.counts[n - 1]) if n else 0


def save(folder: str, name: str | None = None, **arrays: np.ndarray | bytes) -> str:
    """Write arrays as one compressed Arrow file with a new name.

    A new name only reaches the job through the row of the attempt that succeeds, so a repeated task can't mix files. A
    given ``name`` stands for fixed content: a file that is there already is that of an earlier attempt, and stays.
    """
    store, root = pyarrow.fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    draft = uuid.uuid4().hex
    fields, columns = [], []
    for key, value in arrays.items():
        value = np.frombuffer(value, np.uint8) if isinstance(value, bytes) else value
        own = pa.array(np.ascontiguousarray(value))
        columns.append(pa.LargeListArray.from_arrays(pa.array([0, len(own)], pa.int64()), own))
        fields.append(key)
    batch = pa.RecordBatch.from_arrays(columns, names=fields)
    with store.open_output_stream(f"{root}/{draft}") as out:
        with pa.ipc.new_file(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
    if name is None:
        return draft
    if store.get_file_info(f"{root}/{name}").type == pyarrow.fs.FileType.NotFound:
        store.move(f"{root}/{draft}", f"{root}/{name}")
    else:
        store.delete_file(f"{root}/{draft}")
    return name


def load(folder: str, name: str) -> dict[str, np.ndarray]:
    store, root = pyarrow.fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/{name}") as file:
        batch = pa.ipc.open_file(file).get_batch(0)
    return {key: batch.column(key).flatten().to_numpy(zero_copy_only=False) for key in batch.schema.names}


def grouped(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[pa.RecordBatch]]]:
    """(value of ``key``, its rows) from batches in which equal values stand together."""
    current, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column(key).dictionary_encode()
        codes = coded.indices.to_numpy()
        edges = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
        values = coded.dictionary.to_pylist()
        for a, b in zip(edges, edges[1:]):
            value = values[codes[a]]
            if held and value != current:
                yield current, held
                held = []
            current = value
            held.append(batch.slice(a, b - a))
    if held:
        yield current, held
