"""Lookups that skip row groups, and change sets that meet bucketed tables where they lie."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cartloom.contract.model import Check, Column, Reference, Table
from cartloom.operators import mutate
from cartloom.sources import bucketed, snapshot

PARENT = Table("parent", (Column("id", "bigint"),))
CHILD = Table(
    "child", (Column("id", "bigint"), Column("parent_id", "bigint"), Column("n", "int")),
    references=(Reference("parent_id", "parent"),), checks=(Check.compare("n", ">= 0", "not_negative"),))


def scanned_rows(df):
    """Rows that the file scan of a collected plan without shuffles gave out."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_a_lookup_reads_the_row_group_of_its_value(spark, tmp_path):
    rows = spark.range(200_000, numPartitions=4).select(
        F.xxhash64("id").alias("place"), "id", F.md5(F.col("id").cast("string")).alias("code"))
    found = {}
    for name, lookups in (("plain", []), ("bloom", ["code", "id"])):
        path = f"{tmp_path}/{name}"
        snapshot.write_table(rows, path, ["place"], lookups=lookups, group_bytes=1 << 20)
        stored = spark.read.parquet(path)
        code = rows.where("id = 77777").first().code
        for label, lookup in (("code", stored.where(F.col("code") == code)), ("id", stored.where("id = 77777")), ("none", stored.where("code = 'x'")),
                              ("list", stored.where(F.col("id").isin(77777, -5)))):
            assert [r.id for r in lookup.collect()] == ([] if label == "none" else [77777])
            found[name, label] = scanned_rows(lookup)
    (file,) = glob.glob(f"{tmp_path}/bloom/*.parquet")
    meta = pq.ParquetFile(file)
    (group,) = [g for g in range(meta.num_row_groups) if 77777 in meta.read_row_group(g, ["id"])["id"].to_pylist()]
    assert meta.num_row_groups > 3
    # Every group's range holds the values, but only one group's filters do.
    assert found["plain", "code"] == found["plain", "id"] == 200_000
    assert found["bloom", "code"] == meta.metadata.row_group(group).num_rows, (found, meta.metadata)
    assert found["bloom", "id"] == found["bloom", "list"] == found["bloom", "code"]
    assert found["bloom", "none"] == 0


def test_snapshots_carry_the_filters_of_their_lookups(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(50_000).select(F.xxhash64("id").alias("customer_id"), "id")
    version = snapshot.stage(spark, {"orders": rows}, root, {"orders": ["customer_id", "id"]}, group_bytes=64 << 10)
    stored = snapshot.open_version(spark, root, version)["orders"]
    lookup = stored.where("id = 4711")
    assert len(lookup.collect()) == 1
    assert 0 < scanned_rows(lookup) < 25_000


def _shuffles_over(plan: str, name: str) -> bool:
    """Whether a shuffle lies on the way from the scan of a table to the first join over it, in a plan's tree."""
    lines = plan.splitlines()
    for at, line in enumerate(lines):
        if name not in line or "FileScan" not in line and "Scan parquet" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        for above in reversed(lines[:at]):
            indent = len(above) - len(above.lstrip(" :+-*()0123456789"))
            if indent >= depth:
                continue
            depth = indent
            if "Join" in above:
                break
            if "Exchange" in above:
                return True
    return False


def test_a_large_change_set_moves_only_its_keys(spark, tmp_path):
    rows = spark.range(2000).select("id", (F.col("id") % 50).alias("parent_id"), F.lit(1).alias("n"))
    parents = spark.range(50)
    child = bucketed.write(rows, f"{tmp_path}/child", ["id"], 6)
    parent = bucketed.write(parents, f"{tmp_path}/parent", ["id"], 3)
    changes = spark.range(1500, 2500).select(
        "id", (F.col("id") % 60).alias("parent_id"), F.when(F.col("id") % 7 == 0, -1).otherwise(2).alias("n"),
        F.when(F.col("id") < 2000, "update").otherwise("insert").alias("op"))
    plain = mutate.upsert(changes, CHILD, rows, {"parent": parents})
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for sets that no executor holds
    try:
        dealt = mutate.upsert(changes, CHILD, child.rows, {"parent": parent.rows}, {"child": 6, "parent": 3}, broadcast_rows=0)
        plan = dealt.table._jdf.queryExecution().executedPlan().toString()
        other = child.rows.join(spark.range(9).withColumnRenamed("id", "parent_id"), "parent_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(dealt.table.collect()) == sorted(plain.table.collect())
    assert sorted(dealt.rejected.collect()) == sorted(plain.rejected.collect()) and plain.rejected.count() > 100
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert "Bucketed: true" in plan
    assert not _shuffles_over(plan, child.name)
    assert _shuffles_over(other, child.name)  # a join by another column does move them


def test_another_session_attaches_a_bucketed_folder(spark, tmp_path):
    rows = spark.range(100).select("id", F.col("id").cast("string").alias("odd name"))
    written = bucketed.write(rows, f"{tmp_path}/rows", ["id"], 4)
    bucketed.forget(spark, written)
    again = bucketed.attach(spark, f"{tmp_path}/rows", rows.schema, ["id"], 4)
    assert sorted(again.rows.collect()) == sorted(rows.collect())
    plan = again.rows.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
