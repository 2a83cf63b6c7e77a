"""A cuckoo filter over 128-bit keys in numpy: inserts, deletes and lookups of whole arrays."""

from __future__ import annotations

import struct

import numpy as np

SLOTS = 4
HEAD = struct.Struct("<4sI")
LAYER = struct.Struct("<IQ")


def as_words(keys: list[bytes]) -> np.ndarray:
    """16-byte keys as pairs of 64-bit words."""
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


class Layer:
    """Buckets of ``SLOTS`` fingerprints of 16 bits; 0 is an empty slot."""

    def __init__(self, bits: int, table: np.ndarray | None = None, held: int = 0) -> None:
        self.bits, self.held = bits, held
        self.table = np.zeros((1 << bits, SLOTS), np.uint16) if table is None else table
        self.mask = np.uint64((1 << bits) - 1)

    @property
    def room(self) -> int:
        return int(0.85 * self.table.size) - self.held

    def _at(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = (words[:, 1] % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
        return (words[:, 0] >> np.uint64(32)) & self.mask, prints

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ ((prints.astype(np.uint64) * np.uint64(0x5BD1E995)) & self.mask)

    def contains(self, words: np.ndarray) -> np.ndarray:
        bucket, prints = self._at(words)
        other = self._other(bucket, prints)
        return (self.table[bucket] == prints[:, None]).any(1) | (self.table[other] == prints[:, None]).any(1)

    def insert(self, words: np.ndarray, rounds: int = 2000) -> bool:
        """Insert distinct keys; False, with the filter as it was, if they don't fit."""
        before = self.table.copy()
        bucket, prints = self._at(words)
        draw = np.random.default_rng(len(words))
        tried = np.zeros(len(bucket), np.int64)
        for _ in range(rounds):
            if not len(bucket):
                self.held += len(words)
                return True
            free = self.table[bucket] == 0
            slot = free.argmax(1)
            can = free.any(1)
            _, first = np.unique(bucket, return_index=True)  # one key a bucket and round
            now = np.zeros(len(bucket), bool)
            now[first] = True
            put = now & can
            self.table[bucket[put], slot[put]] = prints[put]
            kick = np.flatnonzero(now & ~can & (tried > 0))
            where = draw.integers(0, SLOTS, len(kick))
            out = self.table[bucket[kick], where].copy()
            self.table[bucket[kick], where] = prints[kick]
            prints[kick] = out
            move = now & ~can
            bucket[move] = self._other(bucket[move], prints[move])
            tried[move] += 1
            bucket, prints, tried = bucket[~put], prints[~put], tried[~put]
        self.table = before
        return False

    def delete(self, words: np.ndarray) -> np.ndarray:
        """Take out one fingerprint for each key that has one; which ones had."""
        bucket, prints = self._at(words)
        gone = np.zeros(len(words), bool)
        for place in (bucket, self._other(bucket, prints)):
            open_ = np.flatnonzero(~gone)
            while len(open_):
                hit = self.table[place[open_]] == prints[open_][:, None]
                slot, can = hit.argmax(1), hit.any(1)
                open_, slot = open_[can], slot[can]
                _, first = np.unique(place[open_] * np.uint64(SLOTS) + slot.astype(np.uint64), return_index=True)
                self.table[place[open_[first]], slot[first]] = 0
                gone[open_[first]] = True
                open_ = np.delete(open_, first)
        self.held -= int(gone.sum())
        return gone


class CuckooFilter:
    """Layers of rising size, so that a filter can grow without its keys at hand.

    A key whose fingerprint an older layer has at its place goes there too. So no held key is found in two layers, as
    equal places in a larger layer are equal in a smaller one, and its fingerprint is taken out where it was put in.
    Only if such an older layer is full, a key goes on to the next. Keys found in two layers then stay when they are
    deleted: a filter may hold more than its keys, never less.
    """

    def __init__(self, layers: list[Layer] | None = None) -> None:
        self.layers = layers or []

    def contains(self, words: np.ndarray) -> np.ndarray:
        found = np.zeros(len(words), bool)
        for layer in self.layers:
            found |= layer.contains(words)
        return found

    def insert(self, words: np.ndarray) -> None:
        """Add distinct keys that are not held."""
        for layer in self.layers:
            if layer is self.layers[-1] and layer.room >= len(words) and layer.insert(words):
                return
            there = layer.contains(words)
            if there.any() and layer.insert(words[there]):
                words = words[~there]
        if not len(words):
            return
        size = max(len(words), 2 * sum(x.table.size for x in self.layers))
        bits = max(4, int(np.ceil(np.log2(size / (0.8 * SLOTS)))))
        while True:
            layer = Layer(bits)
            if layer.insert(words):
                self.layers.append(layer)
                return
            bits += 1

    def delete(self, words: np.ndarray) -> None:
        """Take out keys that were inserted."""
        found = np.array([layer.contains(words) for layer in self.layers])
        if not found.size:
            return
        for layer, own in zip(self.layers, found & (found.sum(axis=0) == 1)):
            layer.delete(words[own])

    def to_bytes(self) -> bytes:
        parts = [HEAD.pack(b"cuck", len(self.layers))]
        for layer in self.layers:
            parts += [LAYER.pack(layer.bits, layer.held), layer.table.astype("<u2").tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        magic, n = HEAD.unpack_from(data)
        if magic != b"cuck":
            raise ValueError("this is no cuckoo filter")
        at, layers = HEAD.size, []
        for _ in range(n):
            bits, held = LAYER.unpack_from(data, at)
            at += LAYER.size
            table = np.frombuffer(data, "<u2", SLOTS << bits, at).reshape(-1, SLOTS).copy()
            layers.append(Layer(bits, table, held))
            at += table.nbytes
        return cls(layers)
