"""Hashes of words and word shingles of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cartloom.llm.common import slices

_DRAW = np.random.default_rng(20240229)
_BYTES = _DRAW.integers(0, 2**63, 256).astype(np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _turn(k: int) -> np.uint64:
    """A constant for the place of a word in its shingle."""
    return np.uint64((2 * k + 1) * int(_A) & (2**64 - 1))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(data: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, length and hash of each run of bytes that are not ``blank`` (a table of 256)."""
    solid = np.flatnonzero(~blank[data])
    if not len(solid):
        return solid, solid, np.zeros(0, np.uint64)
    starts = np.flatnonzero(np.append(True, solid[1:] != solid[:-1] + 1))
    sizes = np.diff(np.append(starts, len(solid)))
    place = np.arange(len(solid)) - np.repeat(starts, sizes)
    values = (_BYTES[data[solid]] ^ (place.astype(np.uint64) * _A)) * _B
    values ^= values >> np.uint64(29)
    return solid[starts], sizes, _mix(np.add.reduceat(values * _A, starts) + sizes.astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space), and the number of words of each text."""
    starts, _, hashes = run_hashes(np.frombuffer(b" ".join(texts), np.uint8), _BLANK)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.append(0, np.searchsorted(starts, ends)))


def shingle_hashes(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Per text the hashes of its shingles in order, with repeats; fewer words than ``size`` are one shingle."""
    raw = [(t or "").encode("utf-8").lower() for t in texts]  # of bytes: A-Z only
    words, counts = word_hashes(raw)
    n = len(words)
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed[: n - k] += _mix(words[k:] ^ _turn(k))
    mixed = _mix(mixed)
    found, at = [], 0
    for count in counts.tolist():
        if count >= size:
            found.append(mixed[at : at + count - size + 1])
        elif count:
            whole = np.array([count], np.uint64)
            for k in range(count):
                whole += _mix(words[at + k : at + k + 1] ^ _turn(k))
            found.append(_mix(whole ^ np.uint64(0x5851F42D4C957F2D)))
        else:
            found.append(np.zeros(0, np.uint64))
        at += count
    return found


def parts_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Bounded pieces of batches with the shingles of their texts; hashing takes about forty bytes a byte of text."""
    for batch in batches:
        for part in slices(batch, most=1 << 20):
            yield part, shingle_hashes(part.column("text").to_pylist(), size)
