import random

import pytest

from cartloom.operators import diff, digest_tree


def rows_of(seed, n=600):
    """Keys that are repeated, one of them by a third of all rows, and NULL in either part."""
    draw = random.Random(seed)
    return [(None if draw.random() < 0.02 else 7 if draw.random() < 0.3 else draw.randrange(400), draw.choice(["x", "01", None]), draw.choice([1.5, None, 2.0]), f"n{draw.randrange(5)}")
            for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, part string, v double, note string").repartition(3)


def written(spark, tmp_path, name, rows, digits=1):
    folder = f"file://{tmp_path}/{name}"
    digest_tree.write(frame(spark, rows), ["k", "part"], folder, digits)
    return folder


def test_equals_the_whole_comparison(spark, tmp_path):
    before = rows_of(1)
    draw = random.Random(2)
    after = [r if draw.random() > 0.01 else (*r[:3], "changed") for r in before if draw.random() > 0.01] + [(1000 + i, "new", 1.0, "n") for i in range(4)]
    one, other = written(spark, tmp_path, "a", before), written(spark, tmp_path, "b", after)
    want = sorted(map(str, diff.row_diff(frame(spark, before), frame(spark, after), ["k", "part"]).collect()))
    assert {"added", "changed", "removed", "repeated"} >= {r.change for r in digest_tree.changes(spark, one, other).collect()}
    assert sorted(map(str, digest_tree.changes(spark, one, other).collect())) == want and len(want) > 10


def test_only_differing_buckets_are_read(spark, tmp_path):
    before = [(i, "p", 1.0, "n") for i in range(2_000)]
    after = [(i, "p", 1.0, "other" if i in (3, 900) else "n") for i in range(2_000)]
    one, other = written(spark, tmp_path, "a", before, 2), written(spark, tmp_path, "b", after, 2)
    buckets = digest_tree.differing(spark, one, other)
    assert 1 <= len(buckets) <= 2
    found = digest_tree.changes(spark, one, other)
    assert sorted((r.k, r.change) for r in found.collect()) == [(3, "changed"), (900, "changed")]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan
    # Any other key file may be damaged.
    spoiled = [f for side in "ab" for f in (tmp_path / side / "keys").glob("bucket=*/part-*.parquet") if f.parent.name[-2:] not in buckets]
    assert len(spoiled) > 400
    for file in spoiled:
        (file.parent / f".{file.name}.crc").unlink()
        file.write_bytes(b"no rows")
    assert sorted((r.k, r.change) for r in digest_tree.changes(spark, one, other).collect()) == [(3, "changed"), (900, "changed")]


def test_equal_versions_read_no_keys(spark, tmp_path):
    one, other = written(spark, tmp_path, "a", rows_of(5)), written(spark, tmp_path, "b", list(reversed(rows_of(5))))
    assert digest_tree.differing(spark, one, other) == []
    assert digest_tree.changes(spark, one, other).isEmpty()


def test_trees_are_whole_and_must_match(spark, tmp_path):
    one = written(spark, tmp_path, "a", rows_of(3), digits=2)
    nodes = {(r.depth, r.prefix): r.row_count for r in spark.read.parquet(f"{one}/tree").collect()}
    assert nodes[0, ""] == 600
    assert sum(n for (d, _), n in nodes.items() if d == 1) == sum(n for (d, _), n in nodes.items() if d == 2) == 600
    other = written(spark, tmp_path, "b", rows_of(3), digits=1)
    with pytest.raises(ValueError):
        digest_tree.differing(spark, one, other)
    with pytest.raises(ValueError):
        digest_tree.write(frame(spark, rows_of(3)), ["k"], f"file://{tmp_path}/c", digits=9)


def test_empty_versions(spark, tmp_path):
    one, other = written(spark, tmp_path, "a", []), written(spark, tmp_path, "b", [(1, "p", 1.0, "n")])
    assert [(r.k, r.change) for r in digest_tree.changes(spark, one, other).collect()] == [(1, "added")]
    assert digest_tree.changes(spark, one, one).isEmpty()
