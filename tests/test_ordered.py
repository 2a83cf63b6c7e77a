import random

import pytest
from pyspark.sql import functions as F

from cartloom.operators import ordered


def brute(rows):
    """Reference result of a scan over (key, ts, id, value) tuples."""
    out, state = {}, {}
    for key, ts, ident, value in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        n, total, last = state.get(key, (0, None, None))
        n += 1
        if value is not None:
            total = value if total is None else total + value
        out[ident] = (n, total, last)
        state[key] = (n, total, value)
    return out


def skewed_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for ident in range(n):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "c", f"k{rng.randrange(200)}"])
        ts = 5 if rng.random() < 0.5 else rng.randrange(50)
        rows.append((key, ts, ident, None if rng.random() < 0.1 else rng.randrange(-9, 10)))
    return rows


@pytest.mark.parametrize("task_rows", [40, 500, 1_000_000])
def test_scan_equals_brute_force_on_hot_keys(spark, task_rows):
    rows = skewed_rows(4_000, task_rows)
    df = spark.createDataFrame(rows, "key string, ts int, id bigint, value int").repartition(5)
    result = ordered.scan(
        df, ["key"], ["ts", "id"], number="n", sums={"total": "value"}, previous={"last": "value"}, task_rows=task_rows
    )
    assert set(result.columns) == {"key", "ts", "id", "value", "n", "total", "last"}
    actual = {r.id: (r.n, r.total, r["last"]) for r in result.collect()}
    assert actual == brute(rows)


@pytest.mark.parametrize("task_rows", [64, 1_000_000])
def test_whole_table_numbering(spark, task_rows):
    rows = skewed_rows(3_000, 1)
    df = spark.createDataFrame(rows, "key string, ts int, id bigint, value int").repartition(7)
    numbered = ordered.dense_row_number(df, ["ts", "id"], "n", task_rows=task_rows)
    expected = {r[2]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), start=1)}
    assert {r.id: r.n for r in numbered.collect()} == expected


def test_hot_key_is_spread_over_parts(spark):
    """A third of all rows under one key, and every part near the size asked for."""
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 0, id) AS key", "id")
    placed, parts = ordered.in_ranges(df, ["key", "id"], 500)
    sizes = {r[ordered._PART]: (r.n, r.low, r.high) for r in placed.groupBy(ordered._PART).agg(
        F.count("*").alias("n"), F.min(F.struct("key", "id")).alias("low"), F.max(F.struct("key", "id")).alias("high")).collect()}
    assert 30 <= parts <= 40 and max(n for n, _, _ in sizes.values()) <= 1000
    assert sum(n for n, _, _ in sizes.values()) == 20_000
    ranges = [sizes[p][1:] for p in sorted(sizes)]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(low.key == high.key == 0 for low, high in ranges) >= 8


def test_wide_positions_make_fewer_parts(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BORDER_BYTES", 2_000)
    df = spark.range(4_000).selectExpr("repeat(cast(id % 7 AS string), 300) AS key", "id")
    _, parts = ordered.in_ranges(df, ["key", "id"], 100)
    assert 1 < parts <= 7
    numbered = ordered.scan(df, ["key"], ["id"], number="n", sums={"s": "id"}, task_rows=100)
    wrong = numbered.where((F.col("n") != F.floor(F.col("id") / 7) + 1) | (F.col("s") != 7 * F.col("n") * (F.col("n") - 1) / 2 + F.col("n") * (F.col("id") % 7)))
    assert wrong.isEmpty() and numbered.count() == 4_000


def test_one_shuffle_of_the_rows(spark, tmp_path):
    """The rows are shuffled once, written once, and neither shuffled nor sorted again for the carries."""
    spark.range(30_000).selectExpr("id % 11 AS key", "id", "id % 17 AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    result = ordered.scan(df, ["key"], ["id"], number="n", sums={"s": "v"}, previous={"p": "v"}, task_rows=1_000)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and "FileScan" not in plan and "Sort" not in plan
    placed, parts = ordered.in_ranges(df, ["key", "id"], 1_000)
    local = ordered._scanned(placed.repartitionById(parts, F.col(ordered._PART)), ["key"], ["id"], "n", {"s": "v"}, {"p": "v"}, {}, False)
    plan = local._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Subqueries")[0].count("shufflepartitionidpassthrough") == 1 and plan.count("hashpartitioning") == 0
    want = {}
    rows = sorted((r.key, r.id, r.v) for r in df.collect())
    for key, ident, v in rows:
        n, total, last = want.get(key, {}).get("at", (0, 0, None))
        want.setdefault(key, {})[ident] = (n + 1, total + v, last)
        want[key]["at"] = (n + 1, total + v, v)
    assert all(want[r.key][r.id] == (r.n, r.s, r.p) for r in result.collect())


def test_types_and_names(spark):
    """Decimal sums keep their type over parts; columns named like inner ones of the join stay."""
    df = spark.range(900).selectExpr("cast(id % 2 AS string) AS first", "id AS last", "cast(id AS decimal(9,2)) AS key", "if(id % 5 = 0, null, id) AS v", "id AS n")
    result = ordered.scan(df, ["first"], ["last"], sums={"total": "key"}, previous={"before": "v"}, task_rows=50)
    plain = ordered.scan(df, ["first"], ["last"], sums={"total": "key"}, previous={"before": "v"})
    assert result.schema == plain.schema
    assert sorted(map(str, result.collect())) == sorted(map(str, plain.collect()))


def test_carried_values_and_walks_backwards(spark):
    rows = [r for r in skewed_rows(1_500, 8)]
    df = spark.createDataFrame(rows, "key string, ts int, id bigint, value int").repartition(4)
    for backwards in (False, True):
        want, state = {}, {}
        for key, _, ident, value in sorted(rows, key=lambda r: (r[1], r[2]), reverse=backwards):
            n, total, last, held = state.get(key, (0, None, None, None))
            total = value if total is None else total if value is None else total + value
            held = held if value is None else value
            want[ident] = (n + 1, total, last, held)
            state[key] = (n + 1, total, value, held)
        for task_rows in (60, 1_000_000):
            result = ordered.scan(df, ["key"], ["ts", "id"], number="n", sums={"s": "value"}, previous={"p": "value"}, carried={"c": "value"},
                                  backwards=backwards, task_rows=task_rows)
            assert {r.id: (r.n, r.s, r.p, r.c) for r in result.collect()} == want


@pytest.mark.parametrize("task_rows", [40, 1_000_000])
def test_next_match(spark, task_rows):
    """Hot keys, equal moments on both sides, keys and moments that are NULL, keys without a match."""
    draw = random.Random(6)
    side = lambda n, start: [(draw.choice(["hot", "hot", "a", "b", None]), None if draw.random() < 0.05 else draw.randrange(80), start + i, f"r{i}") for i in range(n)]
    left, right = side(400, 0), [*side(300, 1000), ("only right", 5, 5000, "x")]
    left.append(("only left", 5, 6000, "y"))
    frames = [spark.createDataFrame(x, "k string, at int, id bigint, note string").repartition(3) for x in (left, right)]
    got = ordered.next_match(*frames, ["k"], "at", "id", task_rows=task_rows)
    assert got.columns == ["k", "at", "id", "note", "next_at", "next_id", "next_note"]
    want = []
    for k, at, ident, note in left:
        later = sorted((t, i, n) for key, t, i, n in right if key == k and at is not None and t is not None and t > at)
        want.append((k, at, ident, note, *(later[0] if later else (None, None, None))))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, id int, v int")
    assert ordered.scan(df, ["k"], ["id"], number="n", sums={"s": "v"}, previous={"p": "v"}).collect() == []


def test_ends(spark):
    df = spark.createDataFrame([(1, 2, 5, "b"), (1, 2, 4, "a"), (1, 3, 1, None), (2, 1, 9, "z")], "k int, ts int, id int, s string")
    rows = ordered.ends(df, ["k"], ["ts", "id"], first={"f": "s", "fid": "id"}, last={"l": "s", "lid": "id"}).collect()
    assert {tuple(r) for r in rows} == {(1, "a", 4, None, 1), (2, "z", 9, "z", 9)}


def test_small_parts_share_tasks(spark):
    """2,000 parts in a few tasks: what tasks report to the driver follows the rows, not the parts."""
    df = spark.range(20_000).selectExpr("id % 2 AS key", "id", "cast(id % 7 AS int) AS value")
    _, parts = ordered.in_ranges(df, ["key", "id"], 10)
    result = ordered.scan(df, ["key"], ["id"], number="n", sums={"total": "value"}, previous={"last": "id"}, task_rows=10)
    assert parts >= 1_500 and result.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    wrong = result.where("n <> id div 2 + 1 OR NOT (last <=> if(id < 2, NULL, id - 2))").count()
    totals = {r.key: r.t for r in result.groupBy("key").agg(F.max_by("total", "n").alias("t")).collect()}
    assert (wrong, totals) == (0, {k: sum(i % 7 for i in range(k, 20_000, 2)) for k in (0, 1)})
