import os

import pytest
from pyspark.sql import functions as F

from cartloom.contract import VerificationError
from cartloom.contract.commerce import verify as verify_commerce
from cartloom.generate import profile_named
from cartloom.operators import fingerprint, mutate
from cartloom.sources import files, snapshot
from tests.conftest import ordered_digest

COUNTS = profile_named("small").expected_counts()


def verifier(spark):
    return lambda tables: verify_commerce(spark, tables, COUNTS)


def test_publish_load_reject_and_restore(spark, shop, tmp_path, published_digests):
    root = str(tmp_path)
    with pytest.raises(snapshot.SnapshotError, match="nothing is published"):
        snapshot.load(spark, root)

    first = snapshot.publish(spark, shop, root, verifier(spark), "first")
    loaded = snapshot.load(spark, root, views=True)
    assert spark.sql("SELECT count(*) FROM orders WHERE customer_id = 1").first()[0] == 752

    # Data is the same after the round trip, in the published sense too.
    assert {name: ordered_digest(df) for name, df in loaded.items()} == published_digests["small"]
    golden = spark.createDataFrame(
        fingerprint.of_tables(shop).collect(), "table_name string, row_count bigint, lane_a decimal(38,0), lane_b decimal(38,0)")
    assert snapshot.golden_mismatches(loaded, golden).isEmpty()

    # A build that breaks the contract leaves readers where they were.
    broken = {**shop, "orders": shop["orders"].where("id <> 5")}
    with pytest.raises(VerificationError):
        snapshot.publish(spark, broken, root, verifier(spark), "broken")
    assert snapshot.current_version(spark, root) == first
    assert os.listdir(f"{root}/versions") == [first]

    # A second good version becomes current, and the first can be restored.
    renamed = mutate.update_where(shop["customers"], F.col("id") == 1, {"name": F.lit("Changed value")})
    second = snapshot.publish(spark, {**shop, "customers": renamed}, root, verifier(spark), "second")
    assert snapshot.current_version(spark, root) == second
    changed = snapshot.golden_mismatches(snapshot.load(spark, root), golden).collect()
    assert [r.table_name for r in changed] == ["customers"]
    snapshot.restore(spark, root, first, verifier(spark))
    assert snapshot.current_version(spark, root) == first
    assert [r.sequence for r in snapshot.publications(spark, root).orderBy("sequence").collect()] == [1, 2, 3]
    with pytest.raises(snapshot.SnapshotError, match="is published"):
        snapshot.discard(spark, root, second)


def test_two_publishers_never_share_a_number(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    nothing = snapshot.publications(spark, root)
    assert snapshot._announce(spark, root, "a", "") == 1
    read = snapshot.publications
    monkeypatch.setattr(snapshot, "publications", lambda *_: nothing)  # a publisher that looked before the other announced
    assert snapshot._announce(spark, root, "b", "") == 2
    monkeypatch.setattr(snapshot, "publications", read)
    assert {(r.sequence, r.version) for r in snapshot.publications(spark, root).collect()} == {(1, "a"), (2, "b")}
    assert snapshot.current_version(spark, root) == "b"


def test_files_follow_rows_and_bytes(spark):
    few = spark.range(1000)
    assert snapshot.file_count(few, None) == snapshot.file_count(few, 1000) == 1
    assert snapshot.file_count(few, 3 * snapshot.ROWS_PER_FILE) == 3
    wide = spark.range(100).select("id", F.expr("repeat('x', 10000)").alias("t"))
    assert snapshot.file_count(wide, 1_000_000) == -(-1_000_000 * 10_008 // snapshot.BYTES_PER_FILE)


def test_damaged_files_are_found(spark, shop, tmp_path):
    root = str(tmp_path)
    tables = {"categories": shop["categories"], "products": shop["products"]}
    version = snapshot.stage(spark, tables, root)
    snapshot.check_integrity(spark, root, version)
    extra = shop["products"].where("id = 1")
    extra.write.parquet(f"{root}/versions/{version}/products", mode="append")
    with pytest.raises(snapshot.SnapshotError, match="products"):
        snapshot.check_integrity(spark, root, version)
    with pytest.raises(snapshot.SnapshotError, match="no manifest"):
        snapshot.open_version(spark, root, "unknown")


def test_clustered_layout_skips_files(spark, shop, tmp_path):
    path = str(tmp_path / "orders")
    shop["orders"].repartitionByRange(6, "customer_id", "created_at", "id").sortWithinPartitions(
        "customer_id", "created_at", "id"
    ).write.parquet(path)
    ranges = (
        spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("customer_id").alias("lo"), F.max("customer_id").alias("hi"))
    )
    assert ranges.where("1500 BETWEEN lo AND hi").count() == 1


def test_csv_contract_files(spark, tmp_path):
    path = str(tmp_path / "counts")
    rows = [("small", name, n) for name, n in COUNTS.items()]
    schema = "profile string, table_name string, row_count bigint"
    files.write_csv_report(spark.createDataFrame(rows, schema), path, ["table_name"])
    back = files.read_csv(spark, path, schema)
    assert back.rdd is not None and sorted(map(tuple, back.collect())) == sorted(rows)
    with pytest.raises(Exception):
        files.read_csv(spark, path, "profile string, table_name string, row_count date").collect()


def test_fingerprints_agree_on_equality(spark, shop):
    orders = shop["orders"]
    shuffled = orders.repartition(13, "status")
    changed = mutate.update_where(orders, F.col("id") == 77, {"status": F.lit("PAID")})
    for method in (fingerprint.summed, fingerprint.hashed, lambda d: fingerprint.folded(fingerprint.bucketed(d, 4))):
        assert method(orders).first() == method(shuffled).first()
        assert method(orders).first() != method(changed).first()
    before, after = fingerprint.bucketed(orders, 2), fingerprint.bucketed(changed, 2)
    assert 1 <= before.exceptAll(after).count() <= 2
    assert tuple(fingerprint.folded(before).select("row_count", "lane_a", "lane_b").first()) == tuple(fingerprint.summed(orders).first())
    assert sorted(fingerprint.folded(fingerprint.bucketed(orders, 4), 2).select(*before.columns).collect()) == sorted(before.collect())
    doubled = orders.unionAll(orders)
    assert fingerprint.summed(doubled).first().lane_a == 2 * fingerprint.summed(orders).first().lane_a
    assert fingerprint.summed(orders.limit(0)).first().row_count == 0
    moved = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert fingerprint.hashed(moved.limit(1)).first() != fingerprint.hashed(moved.where("a = 1")).first()
