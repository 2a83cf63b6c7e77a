"""Builders that die, sweeps, and publishers that a sweep overtook."""

import os

import pytest

from cartloom.contract import VerificationError
from cartloom.contract.verify import REPORT_SCHEMA
from cartloom.sources import snapshot


class Killed(BaseException):
    """Stands for the end of a process: no handler of a failed build runs."""


def passing(spark):
    return lambda tables: spark.createDataFrame([], REPORT_SCHEMA)


def die(tables):
    raise Killed


def test_a_sweep_removes_dead_builds_and_leaves_live_ones(spark, tmp_path):
    root = str(tmp_path)
    assert snapshot.sweep(spark, root) == []
    rows = {"t": spark.range(10)}
    published = snapshot.publish(spark, rows, root, passing(spark), lease_seconds=0.0)
    with pytest.raises(Killed):  # between stage and announce
        snapshot.publish(spark, rows, root, die, lease_seconds=0.0)
    (dead,) = set(os.listdir(f"{root}/versions")) - {published}
    live = snapshot.stage(spark, rows, root)
    assert {r.version for r in snapshot.leases(spark, root).collect()} == {dead, live}
    assert snapshot.sweep(spark, root, grace_seconds=3600) == []
    assert snapshot.sweep(spark, root) == [dead]
    assert snapshot.sweep(spark, root) == []
    assert set(os.listdir(f"{root}/versions")) == {published, live}
    assert snapshot.load(spark, root)["t"].count() == 10
    snapshot.restore(spark, root, live, passing(spark))
    assert snapshot.current_version(spark, root) == live


def test_a_publisher_that_was_swept_announces_nothing(spark, tmp_path):
    root = str(tmp_path)
    swept = []

    def late(tables):  # verification outlives the lease, whose renewals fail
        for name in os.listdir(f"{root}/versions"):
            assert snapshot._claim(spark, root, name, snapshot.SWEEP)
            swept.append(name)
        return spark.createDataFrame([], REPORT_SCHEMA)

    with pytest.raises(snapshot.SnapshotError, match="ran out"):
        snapshot.publish(spark, {"t": spark.range(3)}, root, late, lease_seconds=0.0)
    assert snapshot.current_version(spark, root) is None
    assert snapshot.sweep(spark, root) == swept  # the sweep that died after its claim is finished
    assert os.listdir(f"{root}/versions") == []
    with pytest.raises(snapshot.SnapshotError):
        snapshot.restore(spark, root, swept[0], passing(spark))


def test_a_claimed_version_is_not_swept(spark, tmp_path):
    root = str(tmp_path)
    version = snapshot.stage(spark, {"t": spark.range(3)}, root, lease_seconds=0.0)
    assert snapshot._claim(spark, root, version, snapshot.PUBLISH)
    assert snapshot._claim(spark, root, version, snapshot.PUBLISH)
    assert snapshot.sweep(spark, root) == []
    with pytest.raises(snapshot.SnapshotError, match="is published"):
        snapshot.discard(spark, root, version)


def test_a_failed_build_leaves_no_lease(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(VerificationError):
        snapshot.publish(spark, {"t": spark.range(3)}, root, lambda tables: spark.createDataFrame([("a", "t", "= 0", 1, False)], REPORT_SCHEMA))
    assert os.listdir(f"{root}/versions") == []
    assert snapshot.leases(spark, root).isEmpty()
