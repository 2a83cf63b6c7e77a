import pytest
from pyspark.sql import functions as F

from cartloom.contract import verify
from cartloom.contract.model import Check, Column, Contract, Table
from cartloom.sources import snapshot

THINGS = Table("things", (Column("id", "bigint"), Column("name", "string", max_length=4), Column("price", "double", nullable=True)),
               primary_key=("id",), checks=(Check.finite_amount("price"), Check.one_of("name", ["a", "b", "long name"])))
OTHERS = Table("others", (Column("id", "bigint"),), primary_key=("id",))
BOTH = Contract((THINGS, OTHERS))


def tables_of(spark, damaged=True):
    bad = [(5, "long name", 1.0), (6, "z", -2.0), (7, "a", float("nan"))] if damaged else []
    return {"things": spark.createDataFrame([(i, "ab"[i % 2], float(i)) for i in range(5)] + bad, THINGS.schema).repartition(3),
            "others": spark.createDataFrame([], OTHERS.schema)}


def observer_of(contract=BOTH, extra=()):
    return verify.Observer({t.name: verify.row_measures(t) + [m for name, m in extra if name == t.name] for t in contract.tables})


def rows_of(report):
    return sorted(map(tuple, report.collect()))


def test_equals_a_scan_and_reads_nothing_again(spark, tmp_path):
    tables, root = tables_of(spark), f"file://{tmp_path}"
    extra = [("things", verify.Measure("share", "things.a", F.count_if(F.col("name") == "a"), ">= 1")),
             ("others", verify.Measure("row_count", "others", F.count(F.lit(1)), "= 0")),
             ("things", verify.Measure("mean", "things.price", F.max("id"), "= 0", holds=F.max("id") > 3))]
    observer = observer_of(extra=extra)
    version = snapshot.stage(spark, tables, root, clustering={"things": ["name", "id"]}, observer=observer)
    report = snapshot.observed(spark, root, version, observer)
    want = verify.scan_rules(BOTH, tables, extra={name: [m for n, m in extra if n == name] for name in tables})
    assert rows_of(report) == rows_of(want) and not all(r.passed for r in report.collect())
    assert "FileScan" not in report._jdf.queryExecution().executedPlan().toString()
    assert len(rows_of(snapshot.open_version(spark, root, version)["things"])) == 8


def test_a_wrong_count_leads_to_a_scan(spark, tmp_path):
    """As if tasks had counted twice."""
    tables, root = tables_of(spark), f"file://{tmp_path}"
    observer = observer_of()
    version = snapshot.stage(spark, tables, root, clustering={}, observer=observer)

    class Twice:
        get = {k: 2 * v for k, v in observer.taken["things"].get.items()}

    observer.taken["things"] = Twice
    report = snapshot.observed(spark, root, version, observer)
    assert rows_of(report) == rows_of(verify.scan_rules(BOTH, tables))
    assert "FileScan" in report._jdf.queryExecution().executedPlan().toString()


def test_publishing_needs_the_measures(spark, tmp_path):
    passing = lambda tables: verify.scan_rules(BOTH, tables, rule_classes=("not_null",))
    root = f"file://{tmp_path}/shop"
    with pytest.raises(verify.VerificationError):
        snapshot.publish(spark, tables_of(spark), root, passing, clustering={}, observer=observer_of())
    assert not list((tmp_path / "shop" / "versions").iterdir()) and snapshot.current_version(spark, root) is None
    version = snapshot.publish(spark, tables_of(spark, damaged=False), root, passing, clustering={}, observer=observer_of())
    assert snapshot.current_version(spark, root) == version
