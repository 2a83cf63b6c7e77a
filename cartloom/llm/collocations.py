"""Phrase collocations by mergeable Misra-Gries summaries and an exact second pass (operator 11).

Texts are lower-cased (A-Z) and split at marks into pieces, pieces into words. A phrase is a run of words inside one piece,
everything is per language. The phrases that occur at least ``least`` times are found in levels: words, then runs of
two, three, and four to ``LONGEST`` words, of which only those count whose parts survived the levels before (a phrase
is at most as frequent as any part of it, so nothing frequent is left out).

First pass of a level. Documents stand in chunk files of about ``CHUNK_BYTES``. A chunk counts the hashes of its
runs; that is its summary, which had to drop nothing yet, and it goes in slices to the hash partitions. A partition
adds up the mass it was sent, sets a capacity of ``SPARE`` times its mass divided by ``least``, and merges the
slices into one Misra-Gries summary: whenever it holds more entries than that, the count of the first entry beyond
the capacity is taken from all entries, and those at zero or below go. All that was ever taken from an entry is at most
mass / (capacity + 1), less than ``least``; so a run that occurs ``least`` times is still held, with a count not below
``least`` less what was taken. All runs held with such a count survive. Each chunk is told which of its own do, and writes
the places at which they stand beside its file, under a name that a repeated task gives again.

Second pass. Every chunk builds the words of its surviving runs and counts them; the counts travel in slices like the
summaries and are summed by language and words, not by hash, and are exact. A task adds up the counts of its chunks before. Runs that share a hash with a frequent
one end here; hashes have 48 bits, and travel as the compressed differences of their order.

A partition's mass follows the corpus (``PART_MASS`` sets the number of partitions), so neither summaries nor
the slices that wait for their answer grow with it. A phrase that every document holds is one entry per chunk.

Scores are integers: a, n, l and r are exact, and products are decimals of 38 digits.

Defined cases: a null text is empty; a null language is ``und`` and counts together with a language of that name;
rows of one doc_id count one by one; languages without a frequent phrase, and an empty table, give no rows. A text larger
than a chunk is cut at marks, over which no phrase reaches. Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import shared_folder, slices, table
from cartloom.llm.shingles import word_hashes
from cartloom.llm.units import cut, grouped, load, per_text, save
from cartloom.operators.skew import lookup
from cartloom.session import cut_lineage

LEAST = 100
LONGEST = 5
TOP = 2000
COVER_PERCENT = 100
CHUNK_BYTES = 8 << 20
PART_MASS = 2 << 20
SPARE = 4
SPREAD = 1024
TASK_WORDS = 4 << 20
COUNT_TASKS = 4
HELD_ROWS = 1_000_000
COUNTED = ["hash", "lang", "words", "phrase", "n"]
MARKS = b".,;:!?\n\x0b\x0c\r"
BLANK = np.isin(np.arange(256), list(b" \t" + MARKS))
END = np.isin(np.arange(256), list(MARKS))
LEVELS = ((1,), (2,), (3,), tuple(range(4, LONGEST + 1)))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_HASH = np.uint64(0xFFFFFFFFFFFF0000)
_FINE = 22


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & _HASH


def _packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers by the places of their bytes, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpacked(data: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, 8 * count, asbytes=True), np.uint8).reshape(8, count)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    """Hashes in ascending order."""
    return _packed(np.diff(keys >> np.uint64(16), prepend=np.uint64(0)))


def _unpack_keys(data: bytes, count: int) -> np.ndarray:
    return np.cumsum(_unpacked(data, count), dtype=np.uint64) << np.uint64(16)


def _isin(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which ``values`` stand in ``ordered`` hashes; a table of their first bits answers most."""
    found = np.zeros(len(values), bool)
    if len(ordered):
        first = np.zeros(1 << _FINE, bool)
        first[ordered >> np.uint64(64 - _FINE)] = True
        some = np.flatnonzero(first[values >> np.uint64(64 - _FINE)])
        at = np.minimum(np.searchsorted(ordered, values[some]), len(ordered) - 1)
        found[some] = ordered[at] == values[some]
    return found


class Misra:
    """A Misra-Gries summary of hashes with its capacity, merged from counted parts."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.n_waiting += len(keys)
        if self.n_waiting > max(self.capacity, 1 << 16):
            self._settle()

    def _settle(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            beyond = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.taken += beyond
            kept = counts > beyond
            keys, counts = keys[kept], counts[kept] - beyond
        self.keys, self.counts, self.waiting, self.n_waiting = keys, counts, [], 0

    def survivors(self, least: int) -> np.ndarray:
        """Hashes, in order, whose count may be ``least``."""
        self._settle()
        return self.keys[self.counts + self.taken >= least]


def _pieces(text: bytes, most: int) -> list[bytes]:
    """``text`` cut behind marks into parts of about ``most`` bytes; a longer piece is one part."""
    if len(text) <= most:
        return [text]
    ends = np.flatnonzero(END[np.frombuffer(text, np.uint8)]) + 1
    parts, start = [], 0
    while len(text) - start > most and len(ends):
        k = int(np.searchsorted(ends, start + most, "right")) - 1
        k = k if k >= 0 and ends[k] > start else k + 1
        if k >= len(ends):
            break
        parts.append(text[start : int(ends[k])])
        start = int(ends[k])
    return [*parts, text[start:]]


def _write(texts: list[bytes], langs: list[str], folder: str) -> list[tuple[str, str, int]]:
    """Write one chunk; (chunk, language, words) of each of its languages."""
    names = sorted(set(langs))
    of = {name: i for i, name in enumerate(names)}
    data = b"\n".join(texts)
    raw = np.frombuffer(data, np.uint8)
    words, distinct, starts = cut(raw, BLANK)
    counts = per_text(texts, starts)
    lang = np.repeat(np.array([of[x] for x in langs], np.int64), counts)
    own, first, which = np.unique(lang * len(distinct) + words, return_index=True, return_inverse=True)
    # A piece ends between two words if a mark (or the end of a text) stands between them.
    before = np.cumsum(END[raw], dtype=np.int32)[starts]
    sequence = which.astype(np.int32)
    gaps = np.flatnonzero(np.diff(before)) + 1
    sequence = np.insert(sequence, gaps, -1)
    lengths = np.array([*map(len, distinct)], np.int32)
    name = save(folder, names=json.dumps(names).encode("utf-8"), sequence=sequence, words=b"".join(distinct), lengths=lengths,
                word=words[first].astype(np.int32), lang=lang[first].astype(np.int32))
    totals = np.bincount(lang, minlength=len(names)).tolist()
    return [(name, x, n) for x, n in zip(names, totals)]


def chunks(docs: DataFrame, folder: str) -> DataFrame:
    """Write chunk files; (chunk, lang, n): the chunk's words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, langs, held = [], [], 0

        def close() -> pa.RecordBatch:
            rows = _write(texts, langs, folder)
            texts.clear()
            langs.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))], names=["chunk", "lang", "n"])

        for batch in batches:
            for part in slices(batch):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    for piece in _pieces((text or "").encode("utf-8").lower(), CHUNK_BYTES):  # of bytes: A-Z only
                        if texts and held + len(piece) > CHUNK_BYTES:
                            yield close()
                            held = 0
                        texts.append(piece)
                        langs.append(lang)
                        held += len(piece) + 1
        if texts:
            yield close()

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, "chunk string, lang string, n long")


class _Chunk:
    """A chunk file with the places at which the runs stand that survived ``levels`` levels.

    The answers of the last of these levels are given; what the earlier ones left is read from the state beside the file.
    """

    def __init__(self, folder: str, name: str, levels: int = 0, survivors: np.ndarray | None = None) -> None:
        self.folder, self.name, self.levels = folder, name, levels
        own = load(folder, name)
        self.names = json.loads(own["names"].tobytes())
        ends = np.append(0, np.cumsum(own["lengths"])).tolist()
        whole = own["words"].tobytes()
        self.distinct = [whole[a:b] for a, b in zip(ends, ends[1:])]
        self.word, self.lang, self.sequence = own["word"], own["lang"], own["sequence"]
        hashes, _ = word_hashes([b"\n".join(self.distinct)]) if self.distinct else (np.zeros(0, np.uint64), None)
        langs, _ = word_hashes([b"\n".join(n.encode("utf-8").hex().encode() + b"." for n in self.names)])
        self.word_hashes = _mix(hashes[self.word] + _mix(langs[self.lang] + _STEP))
        # Places at which a run of each length stands, in ascending order, and the hashes of these runs.
        self.alive = {1: np.flatnonzero(self.sequence >= 0)}
        self.hashes = {1: self.word_hashes[self.sequence[self.alive[1]]]}
        if levels > 1:
            for key, bits in load(folder, f"{name}-{levels - 1}").items():
                self._hold(int(key), np.flatnonzero(np.unpackbits(bits, count=len(self.sequence))))
        for size in LEVELS[levels - 1] if levels else ():
            self._extend(size)
            kept = _isin(self.hashes[size], survivors)
            self.alive[size], self.hashes[size] = self.alive[size][kept], self.hashes[size][kept]

    def _hold(self, size: int, at: np.ndarray) -> None:
        """Set the places of the runs of ``size``; those of runs one word shorter are known, and hold them all."""
        self.alive[size] = at
        if size == 1:
            self.hashes[1] = self.word_hashes[self.sequence[at]]
        else:
            left = self.hashes[size - 1][np.searchsorted(self.alive[size - 1], at)]
            self.hashes[size] = _mix(left * _STEP + self.word_hashes[self.sequence[at + size - 1]] + np.uint64(size))

    def _extend(self, size: int) -> None:
        """Runs of ``size`` whose two parts of one word less are alive."""
        if size > 1 and size not in self.alive:
            self._extend(size - 1)
            there = np.zeros(len(self.sequence) + 1, bool)
            there[self.alive[size - 1]] = True
            at = self.alive[size - 1]
            self._hold(size, at[there[at + 1]])

    def keep(self) -> None:
        """Write the places that survived as the state after ``levels``."""
        bits = {}
        for size in (s for level in LEVELS[: self.levels] for s in level):
            there = np.zeros(len(self.sequence), bool)
            there[self.alive[size]] = True
            bits[str(size)] = np.packbits(there)
        if bits:
            save(self.folder, f"{self.name}-{self.levels}", **bits)

    def summary(self, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes in order, counts) of the runs of ``sizes``."""
        for size in sizes:
            self._extend(size)
        return np.unique(np.concatenate([self.hashes[s] for s in sizes]), return_counts=True)

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(one row of ``size`` word numbers per distinct surviving run, counts), by their words."""
        at = self.alive[size]
        rows = np.stack([self.sequence[at + k] for k in range(size)], 1)
        _, first, which, counts = np.unique(self.hashes[size], return_index=True, return_inverse=True, return_counts=True)
        if (rows[first][which] != rows).any():  # two runs of one hash
            return np.unique(rows, axis=0, return_counts=True)
        return rows[first], counts

    def counted(self, longest: int) -> pa.Table:
        """(hash, language, number of words, words, count) of every surviving run."""
        words = pa.array([w.decode("utf-8") for w in self.distinct], pa.string())
        tables = []
        for size in range(1, longest + 1):
            rows, counts = self.phrases(size)
            columns = [words.take(pa.array(self.word[rows[:, k]])) for k in range(size)]
            shown = pc.binary_join_element_wise(*columns, " ") if size > 1 else columns[0]
            langs = pa.array([self.names[k] for k in self.lang[rows[:, 0]].tolist()], pa.string())
            tables.append(pa.table([pa.array(self.run_hashes(rows)), langs, pa.array(np.full(len(rows), size, np.int32)), shown, pa.array(counts)], names=COUNTED))
        return pa.concat_tables(tables)

    def run_hashes(self, rows: np.ndarray) -> np.ndarray:
        """Hashes of runs given by their word numbers."""
        found = self.word_hashes[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            found = _mix(found * _STEP + self.word_hashes[rows[:, k]] + np.uint64(k + 1))
        return found


def _slices(parts: int, hashes: np.ndarray) -> list[tuple[int, int, int]]:
    """(hash partition, first, end) of hashes in ascending order."""
    borders = np.searchsorted(hashes >> np.uint64(32), [-(-(p << 32) // parts) for p in range(parts + 1)]).tolist()
    return [(p, a, b) for p, (a, b) in enumerate(zip(borders, borders[1:])) if b > a]


def _added(tables: list[pa.Table]) -> pa.Table:
    """Counts of equal phrases added up."""
    summed = pa.concat_tables(tables).group_by(COUNTED[:4]).aggregate([("n", "sum")])
    return summed.select([*COUNTED[:4], "n_sum"]).rename_columns(COUNTED)


def _sent(tables: list[pa.Table], parts: int) -> Iterator[pa.RecordBatch]:
    """Counts in packed slices by hash partition, in the order of the words."""
    whole = _added(tables)
    whole = whole.take(pc.sort_indices(whole, [("lang", "ascending"), ("phrase", "ascending")])).combine_chunks()
    part = ((whole.column("hash").to_numpy() >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
    for p, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(whole.take(pa.array(order[a:b])).combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["part", "counted"])


def _sums(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Exact counts of the phrases of hash partitions, from ``least`` on."""
    for _, rows in grouped(batches, "part"):
        summed = _added([pa.ipc.open_stream(data).read_all() for batch in rows for data in batch.column("counted").to_pylist()])
        kept = summed.filter(pc.greater_equal(summed.column("n"), least)).drop_columns(["hash"])
        yield from kept.rename_columns(["lang", "words", "phrase", "a"]).combine_chunks().to_batches()


def _told(rows: list[pa.RecordBatch]) -> np.ndarray:
    """The survivors of a chunk, in order."""
    told = [_unpack_keys(keys, n) for batch in rows for n, keys in zip(batch.column("n").to_pylist(), batch.column("hashes").to_pylist())]
    return np.sort(np.concatenate(told))


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Answers of hash partitions: the chunk's runs that survive. Slices that wait for it stay packed."""
    for _, rows in grouped(batches, "part"):
        asked = [row for batch in rows for row in zip(*(batch.column(c).to_pylist() for c in ("chunk", "head", "n", "mass", "hashes", "counts")))]
        summary = Misra(max(1, SPARE * sum(mass for _, _, _, mass, _, _ in asked) // least))
        for _, _, n, _, keys, counts in asked:
            summary.merge(_unpack_keys(keys, n), _unpacked(counts, n).astype(np.int64))
        kept = summary.survivors(least)
        for chunk, head, n, _, keys, _ in asked:
            own = _unpack_keys(keys, n)
            own = own[_isin(own, kept)]
            if head or len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk]), pa.array([len(own)], pa.int32()), pa.array([_pack_keys(own)], pa.binary())], names=["chunk", "n", "hashes"])


def frequent(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, n): all words; (lang, words, phrase, a): phrases of 1 to ``LONGEST`` words with at least ``least`` occurrences)."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "collocations")
    written = cut_lineage(chunks(docs, folder))
    totals = written.groupBy("lang").agg(F.sum("n").alias("n"))
    total = written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // TASK_WORDS))  # rows that name chunks are short; their files are not
    answers = written.select("chunk").distinct().select("chunk", F.lit(0).alias("n"), F.lit(_pack_keys(np.zeros(0, np.uint64))).alias("hashes"))
    for level, sizes in enumerate(LEVELS):
        parts = max(1, -(-total * len(sizes) // PART_MASS))

        def ask(batches: Iterator[pa.RecordBatch], level: int = level, sizes: tuple = sizes, parts: int = parts) -> Iterator[pa.RecordBatch]:
            for name, rows in grouped(batches, "chunk"):
                chunk = _Chunk(folder, name, level, _told(rows))
                chunk.keep()
                keys, counts = chunk.summary(sizes)
                own = _slices(parts, keys) or [(0, 0, 0)]  # a chunk's first slice is answered in any case
                yield pa.RecordBatch.from_arrays([
                    pa.array([p for p, _, _ in own], pa.int32()), pa.array([name] * len(own)), pa.array([True] + [False] * (len(own) - 1)),
                    pa.array([b - a for _, a, b in own], pa.int32()), pa.array([int(counts[a:b].sum()) for _, a, b in own], pa.int64()),
                    pa.array([_pack_keys(keys[a:b]) for _, a, b in own], pa.binary()),
                    pa.array([_packed(counts[a:b]) for _, a, b in own], pa.binary()),
                ], names=["part", "chunk", "head", "n", "mass", "hashes", "counts"])

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _merged(batches, least)

        asked = answers.repartition(tasks, "chunk").sortWithinPartitions("chunk").mapInArrow(
            ask, "part int, chunk string, head boolean, n int, mass long, hashes binary, counts binary")
        placed = asked.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
        answers = cut_lineage(placed.mapInArrow(answer, "chunk string, n int, hashes binary"))
    parts = max(1, -(-total // PART_MASS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows_held = [], 0
        for name, rows in grouped(batches, "chunk"):
            held.append(_Chunk(folder, name, len(LEVELS), _told(rows)).counted(LONGEST))
            rows_held += len(held[-1])
            if rows_held > HELD_ROWS:
                held = [_added(held)]
                rows_held = len(held[0])
                if rows_held > HELD_ROWS // 2:
                    yield from _sent(held, parts)
                    held, rows_held = [], 0
        if held:
            yield from _sent(held, parts)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sums(batches, least)

    wide = max(1, -(-total // (COUNT_TASKS * TASK_WORDS)))  # the more chunks a task has, the fewer rows its counts are
    counted = answers.repartition(wide, "chunk").sortWithinPartitions("chunk").mapInArrow(count, "part int, counted binary")
    placed = counted.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
    return totals, cut_lineage(placed.mapInArrow(add_up, "lang string, words int, phrase string, a long"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, cover_percent: int = COVER_PERCENT) -> DataFrame:
    """Per language of ``docs`` (lang, text) the ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score."""
    totals, known = frequent(docs, least)
    phrases = known.where("words > 1")
    parts = known.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    split = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", "a", "words", split.alias("w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    ends = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    # A word may open or end a large share of all phrases, and a language may hold most of them.
    graded = lookup(ends, parts.withColumnsRenamed({"part": "head", "f": "l"}), ["lang", "head"], broadcast_rows=0)
    graded = lookup(graded, parts.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"], broadcast_rows=0)
    graded = lookup(graded, totals, "lang", broadcast_rows=10_000)
    score = F.expr("(1000 * cast(a as decimal(18,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    least_cut = F.min(F.struct(score.alias("score"), "k", "l", "r", "a", "n")).alias("c")
    scored = graded.groupBy("lang", "phrase").agg(least_cut).select("lang", "phrase", "c.*")

    # Phrases inside longer ones: every longer phrase names its parts of two words and more.
    longer = phrases.where("words > 2").select("lang", "a", "words", split.alias("w"))
    at = longer.select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    at = at.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("i"))
    inside = at.groupBy("lang", F.array_join(F.slice("w", F.col("i"), F.col("size")), " ").alias("phrase")).agg(F.max("a").alias("cover"))
    left = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (F.lit(100) * F.col("cover") < F.lit(cover_percent) * F.col("a")))
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    spread = left.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))  # a language may hold nearly all phrases
    spread = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("rank") <= top)
    first = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return first.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
runs AS (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size)),
known AS (SELECT lang, size, phrase, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : size], ' ') AS rest
  FROM (SELECT lang, phrase, a, size, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM known WHERE size > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n,
         ((1000 * c.a::HUGEINT * n::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT))::BIGINT AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY ((1000 * c.a::HUGEINT * n::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT)), k) AS cut
  FROM cuts c JOIN known x ON x.lang = c.lang AND x.phrase = c.head JOIN known y ON y.lang = c.lang AND y.phrase = c.rest
  JOIN totals t ON t.lang = c.lang),
parts AS (
  SELECT lang, a, array_to_string(w[i : i + s - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, s, unnest(range(1, size - s + 2)) AS i
        FROM (SELECT lang, a, size, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS s FROM known WHERE size > 2))),
covers AS (SELECT lang, phrase, max(a) AS cover FROM parts GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN covers v ON v.lang = s.lang AND v.phrase = s.phrase
  WHERE cut = 1 AND (cover IS NULL OR 100 * cover < 100 * s.a))
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
WHERE rank <= 2000
"""

QUERIES = {"op11_collocations": (op11_collocations, SQL)}
