"""Reversible line dedup: sharded cuckoo filters backed by exact reference-count tables (operator 6).

A line's key is the line without ASCII white space at both ends, A-Z lower-cased; keys of fewer than
``MIN_CHARS`` code points are not looked at. Keys are stored as 128-bit hashes, dealt over shards by their hash. A
``LineIndex`` holds in a folder that all executors share, each version once written and never changed:

* ``refs``: (shard, key, doc_id, version), one row for each document and key: the exact references;
* ``gone``: (doc_id, version), the documents deleted in a version;
* ``counts``: (shard, key, refs, first, version), the number of documents and the smallest doc_id of a key; of
  several rows of a key that with the highest version holds. Only keys that a batch changes get a row;
* ``filters``: per shard a cuckoo filter of all keys held, and one of keys that several documents hold.

``insert`` asks the filters first: a key they don't know is new, and only the others are looked up in the counts.
``delete`` counts the keys of the deleted documents anew and takes keys that fall to no or one document out of the
filters, so lines dropped before come back when their first holder goes. ``drops`` asks the filters of repeated keys
before the exact counts, so only references that are likely to lose lines are joined.

A version counts from the moment its ``state`` file is there, which is written last and names all files of the index. So
``LineIndex(spark, folder)`` opens an index of another session, and an insert or delete that fails half way leaves the
version before as it was; what it wrote has names of its own and is never read. One writer at a time: the second of two that
make the same version is refused.

When the keys held pass ``KEYS_PER_SHARD`` a shard, their number is raised and new filters are written from the exact
counts, so that a shard stays a task's work. The shard that a stored row names is that of its time; reads give the
one of now.

References of a shard are spread over as many tasks as their number asks for, each with the shard's filter, so a line
that a third of all documents hold does not meet in one task. The joins by key may be split by AQE.

Defined cases: a null or empty text is one empty line; a document is a doc_id, rows that share one count as one
document and are cleaned one by one; rows with a null doc_id take no part and keep all lines. A document that is
inserted again must be deleted before. An empty batch changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cartloom.llm.common import shared_folder, slices, table
from cartloom.llm.cuckoo import CuckooFilter, as_words

MIN_CHARS = 10
KEYS_PER_SHARD = 1 << 19
ROWS_PER_TASK = 1 << 18
SEEN, REPEATED = "seen", "repeated"


def key_of(line: bytes) -> bytes | None:
    """The hash of a line's key; None for a short key."""
    key = line.strip().lower()  # of bytes, both mean ASCII only
    if len(key) < MIN_CHARS or (not key.isascii() and sum((b & 0xC0) != 0x80 for b in key) < MIN_CHARS):
        return None
    return xxhash.xxh3_128_digest(key)


def references(docs: DataFrame) -> DataFrame:
    """(key, doc_id), once for each row of ``docs`` and key in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys, ids = [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    own = {key_of(line) for line in text.encode("utf-8").split(b"\n")} - {None}
                    keys += own
                    ids += [doc_id] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "doc_id"])

    known = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return known.mapInArrow(run, "key binary, doc_id long")


def _filter_path(folder: str, shard: int) -> tuple[pyarrow.fs.FileSystem, str]:
    store, root = pyarrow.fs.FileSystem.from_uri(folder)
    return store, f"{root}/shard-{shard:08d}"


def _load(folder: str | None, shard: int) -> CuckooFilter:
    if folder is None:
        return CuckooFilter()
    store, path = _filter_path(folder, shard)
    if store.get_file_info(path).type != pyarrow.fs.FileType.File:
        return CuckooFilter()
    with store.open_input_file(path) as file:
        return CuckooFilter.from_bytes(file.read())


def _put(store: pyarrow.fs.FileSystem, path: str, content: bytes) -> bool:
    """Write a file whole or not at all; False if it was there before."""
    store.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as file:
        file.write(content)
    if store.get_file_info(path).type == pyarrow.fs.FileType.File:
        store.delete_file(draft)
        return False
    store.move(draft, path)
    return True


def _save(folder: str, shard: int, held: CuckooFilter) -> None:
    """The filter of a shard; one that a task wrote before it was repeated holds the same keys and stays."""
    _put(*_filter_path(folder, shard), held.to_bytes())


class LineIndex:
    """The index in a shared folder (a URI); the last version is opened where the folder holds one."""

    #: What a version is: its number, its sizes, and the files that make it up, relative to the folder.
    STATE = ("version", "shards", "most_keys", "refs_paths", "gone_paths", "counts_paths", "filters")

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark, self.folder = spark, folder or shared_folder(spark, "line-index")
        self.version, self.shards = 0, 0
        self.attempt = ""
        self.most_keys = 0  # keys held are no more than this
        self.refs_paths: list[str] = []
        self.gone_paths: list[str] = []
        self.counts_paths: list[str] = []
        self.filters: dict[str, str | None] = {SEEN: None, REPEATED: None}
        if folder:
            self._open()

    def _open(self) -> None:
        store, root = pyarrow.fs.FileSystem.from_uri(self.folder)
        listed = store.get_file_info(pyarrow.fs.FileSelector(f"{root}/state", allow_not_found=True))
        states = sorted(x.path for x in listed if x.path.endswith(".json"))
        if not states:
            return
        with store.open_input_file(states[-1]) as file:
            state = json.loads(file.read())
        here = f"{self.folder}/"
        state["filters"] = {kind: path and here + path for kind, path in state["filters"].items()}
        for name in ("refs_paths", "gone_paths", "counts_paths"):
            state[name] = [here + path for path in state[name]]
        self.__dict__.update(state)

    def _commit(self) -> None:
        """Write the state file of the version, which makes it one."""
        within = len(self.folder) + 1
        state = {name: getattr(self, name) for name in self.STATE}
        state["filters"] = {kind: path and path[within:] for kind, path in self.filters.items()}
        for name in ("refs_paths", "gone_paths", "counts_paths"):
            state[name] = [path[within:] for path in state[name]]
        store, root = pyarrow.fs.FileSystem.from_uri(self.folder)
        if not _put(store, f"{root}/state/version-{self.version:08d}.json", json.dumps(state).encode()):
            raise RuntimeError(f"another writer has made version {self.version} of {self.folder}")

    @contextmanager
    def _change(self) -> Iterator[None]:
        """A new version; if anything fails on the way, the index is what it was."""
        before = {name: getattr(self, name) for name in self.STATE}
        self.refs_paths, self.gone_paths, self.counts_paths = [*self.refs_paths], [*self.gone_paths], [*self.counts_paths]
        self.version, self.attempt = self.version + 1, uuid.uuid4().hex
        try:
            yield
            self._commit()
        except BaseException:
            self.__dict__.update(before)
            raise

    def _write(self, df: DataFrame, name: str, known: list[str]) -> DataFrame:
        path = f"{self.folder}/{name}/version-{self.version:08d}-{self.attempt}"
        df.write.parquet(path)
        known.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def refs(self) -> DataFrame:
        """References of documents that are held now."""
        refs = self._read(self.refs_paths, "shard int, key binary, doc_id long, version int").withColumn("shard", self._shard())
        if not self.gone_paths:
            return refs
        gone = self._read(self.gone_paths, "gone_id long, gone_version int")
        return refs.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.col("gone_version") > F.col("version")), "left_anti")

    def counts(self) -> DataFrame:
        """(shard, key, refs, first) of every key, also of those that no document holds any more (refs 0)."""
        rows = self._read(self.counts_paths, "shard int, key binary, refs long, first long, version int").withColumn("shard", self._shard())
        if len(self.counts_paths) < 2:
            return rows.drop("version")
        last = F.max_by(F.struct("shard", "refs", "first"), "version").alias("last")
        return rows.groupBy("key").agg(last).select("last.shard", "key", "last.refs", "last.first")

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int")

    def _probed(self, rows: DataFrame, kind: str) -> DataFrame:
        """``rows`` (shard, key, a doc_id to spread by, ...) with ``maybe``: whether the shard's filter holds the key."""
        folder = self.filters[kind]
        if folder is None:
            return rows.withColumn("maybe", F.lit(False))
        per_shard = {r["shard"]: r["count"] for r in rows.groupBy("shard").count().collect()}
        tasks = {s: -(-n // ROWS_PER_TASK) for s, n in per_shard.items()}
        starts, total = {}, 0
        for s in sorted(tasks):
            starts[s], total = total, total + tasks[s]
        if not total:
            return rows.withColumn("maybe", F.lit(False))
        layout = self.spark.createDataFrame([(s, starts[s], tasks[s]) for s in tasks], "at_shard int, at int, tasks int")
        placed = rows.join(F.broadcast(layout), F.col("shard") == F.col("at_shard"))
        task = (F.col("at") + F.pmod(F.xxhash64("doc_id"), F.col("tasks"))).cast("int")
        placed = placed.repartitionById(total, task).select(*rows.columns)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, held = None, CuckooFilter()
            for batch in batches:
                if not len(batch):
                    continue
                if batch.column("shard")[0].as_py() != shard:
                    shard = batch.column("shard")[0].as_py()
                    held = _load(folder, shard)
                maybe = held.contains(as_words(batch.column("key").to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe)], names=[*batch.schema.names, "maybe"])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        return placed.mapInArrow(run, f"{schema}, maybe boolean")

    def _grow(self, n: int) -> None:
        """Make room for up to ``n`` more keys: set the number of shards, and deal out the keys held if it rises."""
        self.most_keys += n
        if self.shards and self.most_keys > KEYS_PER_SHARD * self.shards:
            self.most_keys = n + self.counts().where("refs > 0").count()
        if self.shards and self.most_keys <= KEYS_PER_SHARD * self.shards:
            return
        self.shards = max(1, 2 * self.shards, -(-self.most_keys // KEYS_PER_SHARD))
        if self.filters[SEEN] is not None:
            self._refilter(self.counts().withColumn("was", F.lit(0).cast("long")), anew=True)

    def _refilter(self, changes: DataFrame, anew: bool = False) -> None:
        """Write new filters of all shards; ``changes``: (shard, key, was, refs), a row for each changed key.

        With ``anew`` they hold nothing else.
        """
        fresh = {kind: f"{self.folder}/filters/{kind}-{self.version:08d}-{self.attempt}{'-anew' if anew else ''}" for kind in self.filters}
        stale, shards = dict.fromkeys(self.filters) if anew else dict(self.filters), self.shards

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, held = None, {}
            for batch in batches:
                if not len(batch):
                    continue
                if shard is None:
                    shard = batch.column("shard")[0].as_py()
                    held = {kind: _load(folder, shard) for kind, folder in stale.items()}
                words = as_words(batch.column("key").to_pylist())
                was, now = (batch.column(c).to_numpy() for c in ("was", "refs"))
                for kind, least in ((SEEN, 1), (REPEATED, 2)):
                    held[kind].delete(words[(was >= least) & (now < least)])
                    held[kind].insert(words[(was < least) & (now >= least)])
            if shard is not None:
                for kind, own in held.items():
                    _save(fresh[kind], shard, own)
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32())], names=["shard"])

        # every shard gets a row, so that shards without a change are copied to the new version too
        every = self.spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(None).cast("binary").alias("key"),
                                                F.lit(0).cast("long").alias("was"), F.lit(0).cast("long").alias("refs"))
        rows = changes.select("shard", "key", "was", "refs").union(every.withColumn("key", F.lit(b"\0" * 16)))
        rows.repartitionById(shards, F.col("shard")).mapInArrow(run, "shard int").write.format("noop").mode("overwrite").save()
        self.filters = fresh

    def insert(self, docs: DataFrame) -> None:
        """Add documents that the index doesn't hold."""
        with self._change():
            self._insert(docs)

    def _insert(self, docs: DataFrame) -> None:
        found = self._write(references(docs).distinct(), "batch", [])
        self._grow(found.count())
        batch = found.select(self._shard().alias("shard"), "key", "doc_id", F.lit(self.version).alias("version"))
        batch = self._write(batch, "refs", self.refs_paths)
        counted = batch.groupBy("shard", "key").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
        if self.filters[SEEN] is not None:
            counted = self._write(self._probed(counted, SEEN), "counted", [])
            old = self.counts().select(F.col("key").alias("old_key"), F.col("refs").alias("was"), F.col("first").alias("old_first"))
            known = counted.where("maybe").join(old, F.col("key") == F.col("old_key"), "left")
            new = counted.where("not maybe").withColumn("was", F.lit(0).cast("long")).withColumn("old_first", F.lit(None).cast("long"))
            rows = known.select("shard", "key", "n", "doc_id", F.coalesce("was", F.lit(0)).alias("was"), F.when(F.col("was") > 0, F.col("old_first")).alias("old_first"))
            counted = rows.union(new.select(*rows.columns))
        else:
            counted = counted.withColumn("was", F.lit(0).cast("long")).withColumn("old_first", F.lit(None).cast("long"))
        changes = counted.select("shard", "key", (F.col("was") + F.col("n")).alias("refs"), F.least("doc_id", "old_first").alias("first"),
                                 F.lit(self.version).alias("version"), "was")
        self._refilter(self._write(changes, "counts", self.counts_paths))

    def delete(self, doc_ids: DataFrame) -> None:
        """Take out the documents of ``doc_ids`` (doc_id)."""
        if not self.shards:
            return
        with self._change():
            self._delete(doc_ids)

    def _delete(self, doc_ids: DataFrame) -> None:
        leaving = doc_ids.select(F.col("doc_id").cast("long").alias("gone_id")).where("gone_id IS NOT NULL").distinct()
        before = self.refs()
        touched = before.join(leaving, F.col("doc_id") == F.col("gone_id"), "left_semi").groupBy("key").agg(F.count("*").alias("n"))
        touched = self._write(touched.withColumnRenamed("key", "left_key"), "touched", [])
        old = self.counts().join(touched, F.col("key") == F.col("left_key")).select("shard", "key", F.col("refs").alias("was"))
        old = self._write(old, "old", [])
        self._write(leaving.withColumn("gone_version", F.lit(self.version)), "gone", self.gone_paths)
        left = self.refs().join(touched, F.col("key") == F.col("left_key"), "left_semi").groupBy(F.col("key").alias("held_key")).agg(
            F.count("*").alias("n"), F.min("doc_id").alias("least"))
        changes = old.join(left, F.col("key") == F.col("held_key"), "left").select(
            "shard", "key", F.coalesce("n", F.lit(0)).alias("refs"), F.col("least").alias("first"), F.lit(self.version).alias("version"), "was")
        self._refilter(self._write(changes, "counts", self.counts_paths))

    def drops(self) -> DataFrame:
        """(doc_id, drop_keys): the keys whose lines each document loses."""
        likely = self._probed(self.refs().select("shard", "key", "doc_id"), REPEATED).where("maybe")
        repeated = self.counts().where("refs >= 2").select(F.col("key").alias("held_key"), "first")
        lost = likely.join(repeated, F.col("key") == F.col("held_key")).where("first <> doc_id")
        return lost.groupBy(F.col("doc_id").alias("drop_id")).agg(F.collect_list("key").alias("drop_keys"))

    def clean(self, docs: DataFrame) -> DataFrame:
        """Rows of ``docs`` with all columns, ``text`` without the dropped lines, and kept_lines, dropped_lines."""
        extra = ["n_lines", "n_dropped"]
        while set(extra) & set(docs.columns):
            extra = [f"{x}_" for x in extra]
        drop_keys = "drop_keys"
        while drop_keys in docs.columns:
            drop_keys += "_"
        drops = self.drops().withColumnRenamed("drop_keys", drop_keys)
        joined = docs.join(drops, docs["doc_id"].cast("long") == drops["drop_id"], "left").select(*[docs[f"`{c}`"] for c in docs.columns], drop_keys)
        names = docs.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    texts, lines, dropped = [], [], []
                    for text, keys in zip(part.column("text").to_pylist(), part.column(drop_keys).to_pylist()):
                        own = (text or "").encode("utf-8").split(b"\n")
                        if keys:
                            drop = set(keys)
                            kept = [x for x in own if key_of(x) not in drop]
                            text = b"\n".join(kept).decode("utf-8")
                        else:
                            kept = own
                        texts.append(text)
                        lines.append(len(own))
                        dropped.append(len(own) - len(kept))
                    columns = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in names]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, *extra])

        return joined.mapInArrow(run, StructType([*docs.schema.fields, *[StructField(x, LongType()) for x in extra]]))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("long"), "text")
    index = LineIndex(spark)
    index.insert(docs)
    cleaned = index.clean(docs)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_KEY = r"translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT k, doc_id, i, ls[i] AS line FROM (SELECT k, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
keyed AS (SELECT *, {_KEY} AS key FROM l),
held AS (SELECT key, min(doc_id) AS first, count(DISTINCT doc_id) AS n FROM keyed WHERE length(key) >= {MIN_CHARS} AND doc_id IS NOT NULL GROUP BY key),
judged AS (SELECT k, keyed.doc_id, i, line, coalesce(n >= 2 AND keyed.doc_id <> first, false) AS dropped FROM keyed LEFT JOIN held ON keyed.key = held.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(dropped::int) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY k, doc_id
"""

QUERIES = {"op6_line_dedup": (op6_line_dedup, OP6_SQL)}
