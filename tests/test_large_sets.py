"""Large change sets are dealt by their keys to tasks of bounded size."""

from cartloom.contract.model import Check, Column, Table
from cartloom.operators import mutate
from cartloom.sources import bucketed

ROWS = Table(
    "rows", (Column("id", "bigint"), Column("v", "int")), primary_key=("id",), checks=(Check.compare("v", ">= 0", "not_negative"),)
)


def change_set(spark):
    """Of 4,000 ids: inserts of new and of known keys, updates of missing ones, twice the same key, a bad and a null row."""
    rows = spark.range(3_000).selectExpr("id", "cast(id % 5 AS int) AS v")
    made = spark.range(2_000, 4_000).selectExpr("id", "cast(if(id % 7 = 0, -1, 9) AS int) AS v", "if(id % 2 = 0, 'insert', 'update') AS op")
    twice = spark.createDataFrame([(3_500, 1, "insert"), (None, 1, "insert")], "id bigint, v int, op string")
    return rows, made.unionByName(twice)


def expected():
    bad = set()
    for i in range(2_000, 4_000):
        known, insert = i < 3_000, i % 2 == 0
        bad |= {(i, "check", "v.not_negative")} if i % 7 == 0 else set()
        bad |= {(i, "unique", "id")} if known and insert or i == 3_500 else set()
        bad |= {(i, "missing", "id")} if not known and not insert else set()
    kept = {i: i % 5 for i in range(3_000)} | {i: 9 for i in range(2_000, 4_000) if not any(i == k for k, _, _ in bad)}
    return bad, kept


def test_large_sets_are_dealt_by_key(spark, monkeypatch):
    monkeypatch.setattr(mutate, "TASK_ROWS", 1_000)
    monkeypatch.setattr(mutate, "ROWS_PER_DEAL", 100)
    rows, changes = change_set(spark)
    assert mutate._Hint(changes, broadcast_rows=0).dealt(changes, ROWS).rdd.getNumPartitions() == 21
    outcome = mutate.upsert(changes, ROWS, rows, {}, broadcast_rows=0)
    found = {tuple(r) for r in outcome.rejected.where("id IS NOT NULL").collect()}
    assert (found, {r.id: r.v for r in outcome.table.collect()}) == expected()
    assert {r.violation for r in outcome.rejected.where("id IS NULL").collect()} == {"not_null"}


def test_sets_that_fit_tasks_are_left_to_spark(spark):
    _, changes = change_set(spark)
    assert mutate._Hint(changes, broadcast_rows=0).dealt(changes, ROWS) is changes


def test_buckets_hold_few_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bucketed, "ROWS_PER_BUCKET", 250)
    rows, changes = change_set(spark)
    stored = bucketed.write(rows, f"{tmp_path}/rows", ["id"])
    assert stored.buckets == 12
    outcome = mutate.upsert(changes, ROWS, stored.rows, {}, {"rows": stored.buckets}, broadcast_rows=0)
    found = {tuple(r) for r in outcome.rejected.where("id IS NOT NULL").collect()}
    assert (found, {r.id: r.v for r in outcome.table.collect()}) == expected()
    bucketed.forget(spark, stored)
