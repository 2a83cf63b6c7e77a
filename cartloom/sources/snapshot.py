"""Versioned Parquet snapshots that become visible only after they pass verification.

    <root>/versions/<version>/<table>/    data, clustered for the usual queries
    <root>/versions/<version>/manifest/   row counts, schemas and fingerprints
    <root>/publications/<sequence>.json   one file per announcement; whoever creates it has the number
    <root>/leases/<version>.json          until when the builder of a version vouches for it
    <root>/claims/<version>.json          who decided on a version, its publisher or a sweep; whoever creates it has decided

Readers follow the last publication. A failed build leaves the publications, and so all readers, untouched. A build that
dies leaves files and a lease that runs out; ``sweep`` removes both.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.contract.verify import Observer, require
from cartloom.operators import fingerprint

ROWS_PER_FILE = 5_000_000
BYTES_PER_FILE = 256 << 20
LEASE_SECONDS = 3600.0
PUBLICATION_SCHEMA = "sequence bigint, version string, label string, published_at timestamp"
LEASE_SCHEMA = "version string, expires_at double"
PUBLISH, SWEEP = "publish", "sweep"

# Access paths of the commerce tables: rows are range-clustered on these columns, so that file and row-group
# statistics can skip data where a database would use an index.
CLUSTERING = {
    "customers": ["email", "id"],
    "categories": ["parent_id", "id"],
    "products": ["category_id", "id"],
    "orders": ["customer_id", "created_at", "id"],
    "order_items": ["order_id", "id"],
    "payments": ["order_id", "created_at", "id"],
    "shipments": ["order_id", "id"],
    "order_status_history": ["order_id", "changed_at", "id"],
    "inventory_movements": ["product_id", "created_at", "id"],
}

# Generated tables come out in ascending id order, which is also the order of e-mails and order ids. Only these
# need a shuffle to be clustered.
CLUSTERING_OF_GENERATED = {name: CLUSTERING[name] for name in ("categories", "products", "orders", "inventory_movements")}

# Columns of exact lookups that no clustering serves: their files carry Bloom filters.
LOOKUPS = {
    "customers": ["id"],
    "products": ["id", "sku"],
    "orders": ["id"],
    "payments": ["id"],
    "inventory_movements": ["id"],
}
BLOOM_BYTES = 8 << 20  # at most, for a column of a row group; the size that is written follows its distinct values

Verifier = Callable[[dict[str, DataFrame]], DataFrame]


class SnapshotError(RuntimeError):
    """A snapshot is missing, incomplete or does not match its manifest."""


def _version_path(root: str, version: str) -> str:
    return f"{root}/versions/{version}"


def file_count(df: DataFrame, rows: int | None) -> int:
    """Files of at most ``ROWS_PER_FILE`` rows and about ``BYTES_PER_FILE`` bytes.

    Rows are counted where they are not known. The width is that of the typed columns plus the mean of the texts.
    """
    texts = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    fixed = 8 * (len(df.columns) - len(texts))
    if rows is None or texts:
        lengths = [F.avg(F.octet_length(F.col(f"`{c}`").cast("string"))) for c in texts]
        measured = df if rows is None else df.limit(10_000)  # texts of a known number of rows are only sampled
        counted, *means = measured.agg(F.count(F.lit(1)), *lengths).first()
        rows = counted if rows is None else rows
        fixed += sum(float(m or 0) for m in means)
    return max(1, -(-rows // ROWS_PER_FILE), -(-int(rows * fixed) // BYTES_PER_FILE))


def write_table(
    df: DataFrame,
    path: str,
    cluster: list[str] | None,
    rows: int | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
    lookups: list[str] | None = None,
    group_bytes: int | None = None,
) -> None:
    """Range-cluster on the access path and sort inside files; ``watch`` sees the rows as they are written.

    The access path ends in a unique id, so a hot prefix is cut into several files. The number of files follows
    rows and bytes, never the session's parallelism. Row groups carry Bloom filters of the ``lookups`` columns, by which an
    equality or IN filter skips those without the value; ``group_bytes`` is their size, Parquet's own if it isn't given.
    """
    if cluster:
        df = df.repartitionByRange(file_count(df, rows), *cluster).sortWithinPartitions(*cluster)
    df = watch(df) if watch else df
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in lookups or [] if c in df.columns}
    if options:
        options |= {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.max.bytes": str(BLOOM_BYTES)}
    if group_bytes:
        options["parquet.block.size"] = str(group_bytes)
    df.write.option("maxRecordsPerFile", 2 * ROWS_PER_FILE).options(**options).parquet(path, mode="error")


def _manifest(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    schemas = spark.createDataFrame([(n, df.schema.json()) for n, df in tables.items()], "table_name string, schema string")
    return fingerprint.of_tables(tables, fingerprint.hashed).join(F.broadcast(schemas), "table_name")


def stage(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    clustering: dict[str, list[str]] | None = None,
    rows: dict[str, int] | None = None,
    version: str | None = None,
    observer: Observer | None = None,
    lookups: dict[str, list[str]] | None = None,
    group_bytes: int | None = None,
    lease_seconds: float = LEASE_SECONDS,
) -> str:
    """Write all tables and their manifest under a new version that no reader sees yet; an ``observer`` measures on the way.

    The version is leased while it is written and for ``lease_seconds`` after; then a sweep may remove it.
    """
    clustering = CLUSTERING if clustering is None else clustering
    lookups = LOOKUPS if lookups is None else lookups
    version = version or uuid.uuid4().hex
    path = _version_path(root, version)
    with _Lease(spark, root, version, lease_seconds):
        for name, df in tables.items():
            watch = partial(observer.watch, name) if observer else None
            write_table(df, f"{path}/{name}", clustering.get(name), (rows or {}).get(name), watch, lookups.get(name), group_bytes)
        _write_manifest(spark, tables, path)
    return version


def _write_manifest(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> None:
    staged = {name: spark.read.schema(df.schema).parquet(f"{path}/{name}") for name, df in tables.items()}
    _manifest(spark, staged).coalesce(1).write.parquet(f"{path}/manifest", mode="error")


def observed(spark: SparkSession, root: str, version: str, observer: Observer) -> DataFrame:
    """Report of what ``observer`` measured while ``version`` was staged; row counts come from the manifest."""
    counts = spark.read.parquet(f"{_version_path(root, version)}/manifest").select("table_name", "row_count").collect()
    return observer.report(spark, open_version(spark, root, version), {r.table_name: r.row_count for r in counts})


def open_version(spark: SparkSession, root: str, version: str) -> dict[str, DataFrame]:
    """Tables of one version, published or not, with the schemas of its manifest."""
    path = _version_path(root, version)
    try:
        entries = spark.read.parquet(f"{path}/manifest").select("table_name", "schema").collect()
    except AnalysisException as error:
        raise SnapshotError(f"version {version} has no manifest") from error
    return {
        e.table_name: spark.read.schema(T.StructType.fromJson(json.loads(e.schema))).parquet(f"{path}/{e.table_name}")
        for e in entries
    }


def check_integrity(spark: SparkSession, root: str, version: str) -> dict[str, DataFrame]:
    """Recompute all fingerprints and compare them with the manifest; returns the tables."""
    tables = open_version(spark, root, version)
    stored = spark.read.parquet(f"{_version_path(root, version)}/manifest").drop("schema")
    broken = [r.table_name for r in fingerprint.mismatches(stored, fingerprint.of_tables(tables, fingerprint.hashed)).collect()]
    if broken:
        raise SnapshotError(f"content differs from the manifest: {', '.join(sorted(broken))}")
    return tables


def publications(spark: SparkSession, root: str) -> DataFrame:
    """(sequence, version, label, published_at) of all announcements; a row that is still being written is left out."""
    try:
        return spark.read.schema(PUBLICATION_SCHEMA).json(f"{root}/publications").where("version IS NOT NULL")
    except AnalysisException:
        return spark.createDataFrame([], PUBLICATION_SCHEMA)


def current_version(spark: SparkSession, root: str) -> str | None:
    return publications(spark, root).agg(F.max_by("version", "sequence").alias("v")).first().v


def _store(spark: SparkSession, path: str):
    """The file system of a path, and the path in its form."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _write(spark: SparkSession, path: str, entry: dict, overwrite: bool = False) -> bool:
    """Write a small JSON file; False if it must be new and another writer has created it."""
    store, place = _store(spark, path)
    if not overwrite and store.exists(place):
        return False
    try:
        out = store.create(place, overwrite)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        return False
    try:
        out.write(bytearray(json.dumps(entry).encode()))
    finally:
        out.close()
    return True


def _announce(spark: SparkSession, root: str, version: str, label: str) -> int:
    """Take the next free sequence number by creating its file, which fails if another publisher has it."""
    sequence = (publications(spark, root).agg(F.max("sequence")).first()[0] or 0) + 1
    while True:
        entry = {"sequence": sequence, "version": version, "label": label,
                 "published_at": datetime.now(timezone.utc).isoformat(timespec="milliseconds")}
        if _write(spark, f"{root}/publications/{sequence:010d}.json", entry):
            return sequence
        sequence += 1


def _claim(spark: SparkSession, root: str, version: str, by: str) -> bool:
    """Decide on a version for good: True for the side that was first, and again whenever that side asks."""
    path = f"{root}/claims/{version}.json"
    if _write(spark, path, {"version": version, "by": by}):
        return True
    held = spark.read.schema("version string, by string").json(path).where("version IS NOT NULL").select("by").collect()
    return [r.by for r in held] == [by]


class _Lease:
    """The builder's word that a version is in work, renewed by a thread every third of its term.

    A renewal that fails is tried again at the next beat. A lease that runs out nevertheless costs the build, never the readers: a
    version that a sweep has claimed can't be announced.
    """

    def __init__(self, spark: SparkSession, root: str, version: str, seconds: float):
        self.spark, self.root, self.version, self.seconds = spark, root, version, seconds
        self.over = threading.Event()
        self.beat = threading.Thread(target=self._keep, daemon=True)

    def renew(self) -> None:
        _write(self.spark, _lease_path(self.root, self.version), {"version": self.version, "expires_at": time.time() + self.seconds}, True)

    def _keep(self) -> None:
        while not self.over.wait(max(self.seconds / 3, 0.1)):
            try:
                self.renew()
            except Py4JJavaError:
                continue

    def __enter__(self) -> _Lease:
        self.renew()
        self.beat.start()
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.over.set()
        self.beat.join()
        if kind is None:
            self.renew()


def _lease_path(root: str, version: str) -> str:
    return f"{root}/leases/{version}.json"


def leases(spark: SparkSession, root: str) -> DataFrame:
    """(version, expires_at) of all builds that were neither published nor removed; one that is being rewritten is left out."""
    try:
        return spark.read.schema(LEASE_SCHEMA).option("ignoreMissingFiles", "true").json(f"{root}/leases").where("version IS NOT NULL")
    except AnalysisException:
        return spark.createDataFrame([], LEASE_SCHEMA)


def _remove(spark: SparkSession, path: str) -> None:
    store, place = _store(spark, path)
    store.delete(place, True)


def discard(spark: SparkSession, root: str, version: str) -> None:
    """Remove the files of a version that was never published, and its lease after them."""
    published = not publications(spark, root).where(F.col("version") == version).isEmpty()
    if published or not _claim(spark, root, version, SWEEP):
        raise SnapshotError(f"version {version} is published")
    _remove(spark, _version_path(root, version))
    _remove(spark, _lease_path(root, version))


def sweep(spark: SparkSession, root: str, grace_seconds: float = 0.0) -> list[str]:
    """Remove the versions of builders that died: their lease ran out over ``grace_seconds`` ago, and nobody announced them.

    A sweep claims a version before it deletes anything, and a publisher before it announces, by creating the same file, so
    only one of them can go on. A sweep that dies half way is finished by the next. Versions that a publisher claimed, but
    has not announced, stay: they are verified, and ``restore`` can announce them. Returns the versions removed.
    """
    expired = leases(spark, root).where(F.col("expires_at") < time.time() - grace_seconds)
    dead = [r.version for r in expired.join(publications(spark, root), "version", "left_anti").select("version").distinct().collect()]
    swept = [version for version in dead if _claim(spark, root, version, SWEEP)]
    for version in swept:
        _remove(spark, _version_path(root, version))
        _remove(spark, _lease_path(root, version))
    return sorted(swept)


def publish(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    verifier: Verifier,
    label: str = "",
    clustering: dict[str, list[str]] | None = None,
    rows: dict[str, int] | None = None,
    observer: Observer | None = None,
    lookups: dict[str, list[str]] | None = None,
    lease_seconds: float = LEASE_SECONDS,
) -> str:
    """Stage, verify what was written, and only then announce it; a version that fails leaves no files.

    Measures of an ``observer`` are taken while the tables are written and must hold too; ``verifier`` need not repeat them.
    The version is leased until it is announced, so a sweep leaves it alone.
    """
    version = uuid.uuid4().hex
    with _Lease(spark, root, version, lease_seconds):
        try:
            stage(spark, tables, root, clustering, rows, version, observer, lookups, None, lease_seconds)
            if observer:
                require(observed(spark, root, version, observer))
            require(verifier(open_version(spark, root, version)))
        except Exception:
            discard(spark, root, version)
            raise
        if not _claim(spark, root, version, PUBLISH):
            raise SnapshotError(f"the lease of version {version} ran out, and a sweep removed it")
        _announce(spark, root, version, label)
    _remove(spark, _lease_path(root, version))
    return version


def load(spark: SparkSession, root: str, verifier: Verifier | None = None, views: bool = False) -> dict[str, DataFrame]:
    """Tables of the current publication, after the integrity check and an optional verification."""
    version = current_version(spark, root)
    if version is None:
        raise SnapshotError(f"nothing is published under {root}")
    tables = check_integrity(spark, root, version)
    if verifier:
        require(verifier(tables))
    if views:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    return tables


def restore(spark: SparkSession, root: str, version: str, verifier: Verifier, label: str = "restore") -> None:
    """Make an older version current again, after the same checks as a new one."""
    require(verifier(check_integrity(spark, root, version)))
    if not _claim(spark, root, version, PUBLISH):
        raise SnapshotError(f"a sweep removed version {version}")
    _announce(spark, root, version, label)


def golden_mismatches(tables: dict[str, DataFrame], golden: DataFrame) -> DataFrame:
    """Tables whose summed fingerprint differs from (table_name, row_count, lane_a, lane_b)."""
    known = golden.withColumns({lane: F.col(lane).cast(fingerprint.DECIMAL) for lane in ("lane_a", "lane_b")})
    return fingerprint.mismatches(known, fingerprint.of_tables(tables, fingerprint.summed))
