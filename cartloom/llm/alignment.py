"""Alignment of the tokens of a byte-level tokenizer (A) and a SentencePiece model (B) over one text (operator 13).

Both encode a space and the text. Their spans (character offsets of the tokenizers library, byte spans of the
SentencePiece proto) are the coarse cuts; a token that ends inside a character (a part of a multibyte character on
either side, a byte-fallback piece, the piece of the space that the model adds) has no such span, and its end is the
last coarse cut plus the decoded bytes since. Where both sides end a token, the text is cut into groups, and
every A token of a group is linked to every B token of it. The decoded bytes of both sides are compared with the text;
texts that either side doesn't give back have no tokens.

Neither side has a token over a single space between two other characters, so plain texts are cut there into units.
A mark between an ASCII letter and a space is a unit of its own, if no piece of B holds a letter and a mark after it. A
unit's ids, groups and links don't depend on where it stands: each distinct unit is encoded and aligned once
per worker and kept within ``KEPT_BYTES``. Texts with other white space at a space are one unit of their own.

Counts over the corpus take three steps. Documents are gathered into chunks of about ``CHUNK_BYTES``; a chunk's unit
sequences, digests and links go to one file in the shared folder, and its distinct id pairs with the number of its
documents that hold them go to the shuffle. The summed counts, with the best one of each A id, return to the chunks that
asked for them, in the order of their pairs, and one task per chunk reads the file and adds up. Links
themselves are never shuffled, so a pair that every document holds is one row per chunk.

Defined cases: texts that are null, empty or not given back have no tokens, zeros and an empty digest; rows of one
doc_id are documents of their own and count one by one; an empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import shared_folder, slices, table
from cartloom.llm.units import MARKS, Memory, Rows, cut, grouped, load, marked, per_text, ranges, save
from cartloom.session import cut_lineage

CHUNK_BYTES = 8 << 20
KEPT_BYTES = 128 << 20
JOINED_BYTES = 1 << 16
MANY_LINKS = 4096  # groups of more links are kept as distinct pairs with their numbers
SPACE = "▁"
HOST = "a"
CODED_MARK = 0xF8  # bytes that no text holds stand for marks that are units
CODED = np.zeros(256, np.uint8)
CODED[list(MARKS)] = CODED_MARK + np.arange(len(MARKS))


def byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable Latin-1 stands for itself, the others follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, and what a worker keeps about units."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        of = byte_alphabet()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.a_bytes = [bytes(of[c] for c in n) if all(c in of for c in n) else n.encode("utf-8") for n in names]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(n[1:-1], 16)]) if self.b.is_byte(i) else n.replace(SPACE, " ").encode("utf-8") for i, n in enumerate(names)]
        self.a_sizes, self.b_sizes = (np.array([*map(len, x)]) for x in (self.a_bytes, self.b_bytes))
        self.numbers = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        inner = any(SPACE in n.lstrip(SPACE) and not self.b.is_control(i) for i, n in enumerate(names))
        self.cuttable = not inner
        self.blanks = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"] + [SPACE]
        self.markable = not any(re.search(f"[A-Za-z][{MARKS.decode()}]", n) for n in names)
        self.shift = len(names).bit_length()
        self.memory = Memory(KEPT_BYTES)
        self.facts, self.links = Rows(np.int64), Rows(np.int64)  # n_a, n_b, n_groups, n_links; links as in `_coded`
        self.groups: list[bytes] = []

    def _coded(self, a: np.ndarray, b: np.ndarray, times: np.ndarray | int) -> np.ndarray:
        """A link and how often it occurs as one number; ids of A take at most 24 bits."""
        return (times << (self.shift + 24)) | (a << self.shift) | b

    def decoded(self, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair as id of A * 2^32 + id of B, times)."""
        a = (links >> self.shift) & 0xFFFFFF
        return (a << 32) | (links & ((1 << self.shift) - 1)), links >> (self.shift + 24)

    # One text

    def plain(self, text: str) -> bool:
        """Whether the text is cut at its spaces: all of them single, between other characters, and no U+2581."""
        if not self.cuttable or not text or text[0].isspace() or text[-1].isspace() or "  " in text or " \n" in text or "\n " in text:
            return False
        return not any(c in text for c in self.blanks)

    def ends(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """(ids of A, byte after each, ids of B, byte after each) in space + text; None if either doesn't give it back."""
        data = (" " + text).encode("utf-8")
        own = self.a.encode(" " + text, add_special_tokens=False)
        a = np.array(own.ids, np.int64)
        if b"".join([self.a_bytes[i] for i in own.ids]) != data:
            return None
        pieces = self.b.encode(text, return_type="proto").pieces
        b, begin, end = np.array([(p.id, p.begin, p.end) for p in pieces], np.int64).reshape(-1, 3).T
        if b"".join([self.b_bytes[i] for i in b.tolist()]) != data:
            return None
        raw = np.frombuffer(data, np.uint8)
        place = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # first byte of every character
        spans = np.array(own.offsets, np.int64).reshape(-1, 2)
        whole_a = np.append(spans[1:, 0] >= spans[:-1, 1], True)
        whole_b = end > begin
        return a, _refined(place[spans[:, 1]], whole_a, self.a_sizes[a]), b, _refined(end + 1, whole_b, self.b_sizes[b])

    def align(self, text: str) -> tuple[np.ndarray, ...] | None:
        """:func:`ends` with the group of every A and every B token."""
        found = self.ends(text)
        if found is None:
            return None
        a, a_ends, b, b_ends = found
        both = np.intersect1d(a_ends, b_ends, assume_unique=True)
        return a, np.searchsorted(both, a_ends), b, np.searchsorted(both, b_ends), both

    # Many units

    def _describe(self, text: str, unit_ends: np.ndarray) -> bool:
        """Add the units of a joint text, which end at these bytes of space + text, to the stores; False if that can't be done."""
        found = self.align(text)
        if found is None:
            return False
        a, ga, b, gb, both = found
        last = np.searchsorted(both, unit_ends)  # last group of every unit
        if len(unit_ends) > 1 and (both[np.minimum(last, len(both) - 1)] != unit_ends).any():
            return False
        n = len(both)
        na, nb = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
        a_from, b_from = np.append(0, np.cumsum(na)), np.append(0, np.cumsum(nb))
        names = self.numbers
        sa, sb = [names[i] for i in a.tolist()], [names[i] for i in b.tolist()]
        al, bl = a_from.tolist(), b_from.tolist()
        shown = [f"{sa[i] if j - i == 1 else ','.join(sa[i:j])}|{sb[k] if m - k == 1 else ','.join(sb[k:m])}"
                 for i, j, k, m in zip(al, al[1:], bl, bl[1:])]
        first_group = np.append(0, last[:-1] + 1)
        products = na * nb
        plain_ones = np.where(products <= MANY_LINKS, products, 0)
        owner = np.repeat(np.arange(n), plain_ones)
        at = ranges(np.zeros(n, np.int64), plain_ones)
        links = self._coded(a[a_from[owner] + at // nb[owner]], b[b_from[owner] + at % nb[owner]], 1)
        kept = plain_ones.copy()
        for g in np.flatnonzero(products > MANY_LINKS).tolist():
            (x, cx), (y, cy) = (np.unique(s, return_counts=True) for s in (a[a_from[g] : a_from[g + 1]], b[b_from[g] : b_from[g + 1]]))
            place = int(kept[:g].sum())
            links = np.insert(links, place, self._coded(x[:, None], y, cx[:, None] * cy).ravel())
            kept[g] = len(x) * len(y)
        groups = np.append(0, np.cumsum(kept))
        unit_links = groups[last + 1] - groups[first_group]
        self.links.add(links, unit_links)
        totals = [np.add.reduceat(x, first_group) for x in (na, nb, np.ones(n, np.int64), products)]
        self.facts.add(np.stack(totals, 1).ravel(), np.full(len(unit_ends), 4))
        self.groups += [";".join(shown[i : j + 1]).encode() for i, j in zip(first_group.tolist(), last.tolist())]
        return True

    def _nothing(self) -> None:
        """A unit that isn't given back: -1 tokens."""
        self.links.add(np.zeros(0, np.int64), np.zeros(1, np.int64))
        self.facts.add(np.array([-1, 0, 0, 0]), np.array([4]))
        self.groups.append(b"")

    def _learn(self, units: list[bytes]) -> None:
        """Add new units in their order; neighbours are encoded together, coded marks after a letter."""
        i = 0
        while i < len(units):
            if units[i][0] >= CODED_MARK:
                before = self.facts.n
                self._describe(HOST + chr(MARKS[units[i][0] - CODED_MARK]), np.array([2, 3]))
                self._drop(before)
                i += 1
                continue
            j, held = i, 0
            while j < len(units) and units[j][0] < CODED_MARK and (j == i or held + len(units[j]) < JOINED_BYTES):
                held += len(units[j]) + 1
                j += 1
            ends = np.cumsum([len(u) + 1 for u in units[i:j]])
            if not self._describe(b" ".join(units[i:j]).decode("utf-8"), ends):
                for unit in units[i:j]:
                    if not self._describe(unit.decode("utf-8"), np.array([len(unit) + 1])):
                        self._nothing()
            i = j

    def _drop(self, number: int) -> None:
        """Leave out the first of the two units that were added last."""
        for rows in (self.facts, self.links):
            last, _ = rows.get(np.array([number + 1]))
            rows.cut_back(number)
            rows.add(last, np.array([len(last)]))
        del self.groups[number]

    def place(self, texts: list[str]) -> tuple[list[np.ndarray], int]:
        """(units of every text, number of units before); call :meth:`settle` with it once the units were used."""
        before = self.facts.n
        plain = [self.plain(t) for t in texts]
        raw = [t.encode("utf-8") for t, p in zip(texts, plain) if p]
        data = np.frombuffer(b" ".join(raw), np.uint8)
        marks = marked(data) if self.markable else None
        if marks is not None:
            data = data.copy()
            data[marks] = CODED[data[marks]]
        units, distinct, starts = cut(data, breaks=marks)
        numbers, new = self.memory.place(distinct)
        self._learn(new)
        joint = iter(np.split(numbers[units], np.cumsum(per_text(raw, starts))[:-1]) if raw else [])
        found = []
        for text, p in zip(texts, plain):
            own = next(joint) if p else None
            if own is None or (self.facts.get(own)[0][::4] < 0).any():
                if not text or not self._describe(text, np.array([len(text.encode("utf-8")) + 1])):
                    self._nothing()
                own = np.array([self.facts.n - 1])
            found.append(own)
        return found, before

    def settle(self, before: int) -> None:
        """Keep what was learned about units since ``before``, as far as the bound goes; whole texts are always forgotten."""
        fresh = slice(before, before + len(self.memory.fresh))
        sizes = np.array([*map(len, self.groups[fresh])], np.int64) + 120 + 8 * self.links.counts[fresh]
        kept = before + self.memory.settle(sizes)
        self.facts.cut_back(kept)
        self.links.cut_back(kept)
        del self.groups[kept:]


def _refined(coarse: np.ndarray, whole: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte after every token: its span's end where it has one, else the last one before plus the decoded bytes since."""
    decoded = np.cumsum(sizes)
    known = np.where(whole, np.arange(len(sizes)), -1)
    last = np.maximum.accumulate(known)
    return np.where(last >= 0, coarse[last] + decoded - decoded[last], decoded)


class _Chunk:
    """Documents on their way to a chunk file."""

    def __init__(self, pair: Pair, folder: str) -> None:
        self.pair, self.folder = pair, folder
        self.clear()

    def clear(self) -> None:
        self.doc_ids: list[int | None] = []
        self.digests: list[bytes] = []
        self.facts: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []  # distinct pairs of every document
        self.times: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_ids: list[int | None], texts: list[str]) -> None:
        pair = self.pair
        sequences, before = pair.place(texts)
        for doc_id, units in zip(doc_ids, sequences):
            facts = pair.facts.get(units)[0].reshape(-1, 4).sum(axis=0)
            self.doc_ids.append(doc_id)
            self.facts.append(np.maximum(facts, 0))
            self.digests.append(hashlib.sha256(b";".join(map(pair.groups.__getitem__, units.tolist()))).digest() if facts[0] > 0 else b"\0" * 32)
            keys, times = pair.decoded(pair.links.get(units)[0])
            order = np.argsort(keys)
            keys, times = keys[order], times[order]
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            self.keys.append(keys[first])
            self.times.append(np.add.reduceat(times, first) if len(first) else times)
        pair.settle(before)

    def close(self) -> pa.RecordBatch:
        """Write the file; rows (chunk, a, b, n) of its pairs in ascending order, after a row of nulls."""
        counts = np.array([*map(len, self.keys)], np.int64)
        flat = np.concatenate(self.keys)
        keys, which, n = np.unique(flat, return_inverse=True, return_counts=True)
        known = np.array([d is not None for d in self.doc_ids])
        name = save(
            self.folder, doc_id=np.array([d or 0 for d in self.doc_ids], np.int64), known=known.astype(np.uint8),
            facts=np.concatenate(self.facts), digests=b"".join(self.digests), counts=counts,
            steps=np.diff(which, prepend=0).astype(np.int32), times=np.concatenate(self.times))
        self.clear()
        null = np.append(True, np.zeros(len(keys), bool))
        columns = [pa.array(np.append(0, x), pa.int32(), mask=null) for x in (keys >> 32, keys & 0xFFFFFFFF)]
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * (len(keys) + 1)), *columns, pa.array(np.append(0, n), pa.int64())], names=["chunk", "a", "b", "n"])


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(byte_level: str, pieces: str) -> Pair:
    """Both tokenizers once per Python worker."""
    if (byte_level, pieces) not in _PAIRS:
        _PAIRS[byte_level, pieces] = Pair(byte_level, pieces)
    return _PAIRS[byte_level, pieces]


def chunks(docs: DataFrame, byte_level: str, pieces: str, folder: str) -> DataFrame:
    """Write chunk files; (chunk, a, b, n): the chunk's documents that hold a pair, and a row without a pair per chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(pair_of(byte_level, pieces), folder)
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                size = sum(map(len, texts))
                if chunk.doc_ids and chunk.bytes + size > CHUNK_BYTES:
                    yield chunk.close()
                chunk.add(part.column("doc_id").to_pylist(), texts)
                chunk.bytes += size
        if chunk.doc_ids:
            yield chunk.close()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "chunk string, a int, b int, n long")


def _sums(pairs: np.ndarray, times: np.ndarray, counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Per document the sum of its links' ``values``."""
    sums = np.append(0, np.cumsum(values[pairs] * times))
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def aligned(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    folder = shared_folder(docs.sparkSession, "alignment")
    asked = cut_lineage(chunks(docs, byte_level, pieces, folder))
    counts = asked.where(F.col("a").isNotNull()).groupBy("a", "b").agg(F.sum("n").alias("held"))
    best = F.max("held").over(Window.partitionBy("a"))  # an id of A has no more partners than B has ids
    graded = counts.withColumn("best", F.col("held") == best)
    answers = asked.join(graded, ["a", "b"]).select("chunk", "a", "b", "held", "best")
    heads = asked.where(F.col("a").isNull()).select("chunk", "a", "b", F.lit(0).cast("long").alias("held"), F.lit(False).alias("best"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in grouped(batches, "chunk"):
            held, best = (np.concatenate([b.column(c).cast(pa.int64()).fill_null(0).to_numpy() for b in rows])[1:] for c in ("held", "best"))
            own = load(folder, name)
            facts = own["facts"].reshape(-1, 4)
            digests = own["digests"].tobytes()
            link = np.cumsum(own["steps"], dtype=np.int64), own["times"], own["counts"]
            yield pa.RecordBatch.from_arrays([
                pa.array(own["doc_id"], mask=own["known"] == 0), *(pa.array(facts[:, k]) for k in range(4)),
                pa.array(_sums(*link, best)), pa.array(_sums(*link, held)),
                pa.array([digests[32 * i : 32 * i + 32].hex() if n else "" for i, n in enumerate(facts[:, 0].tolist())]),
            ], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return (answers.union(heads).repartition("chunk").sortWithinPartitions("chunk", F.col("a").asc_nulls_first(), "b").mapInArrow(
        finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return aligned(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op13_alignment": (op13_alignment, None)}
