import csv
import glob

import pytest

from cartloom import jobs
from cartloom.contract.commerce import COMMERCE
from cartloom.contract.counts import COUNT_SCHEMA, expected_counts
from cartloom.generate import profile_named
from cartloom.operators.diff import relation_diff


def read_report(folder, name):
    (path,) = glob.glob(f"{folder}/{name}/part-*.csv")
    with open(path, newline="") as lines:
        return list(csv.DictReader(lines))


def test_build_verify_and_report(spark, tmp_path, capsys, published_namespace):
    root, out = str(tmp_path / "data"), str(tmp_path / "out")
    assert jobs.main(["build", "--root", root, "--namespace", published_namespace]) == 0
    assert jobs.main(["verify", "--root", root]) == 0
    # The fingerprints of the generated rows are met, and a changed one is named.
    assert jobs.main(["fingerprint", "--root", root, "--csv", out]) == 0
    prints = read_report(out, "fingerprints")
    assert [r["table_name"] for r in prints] == sorted(COMMERCE.names)
    golden = [",".join(r.values()) for r in prints]
    for name, lines, status in (("same", golden, 0), ("other", [golden[0] + "1", *golden[1:]], 1)):
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join([",".join(prints[0]), *lines]) + "\n")
        assert jobs.main(["verify", "--root", root, "--golden", str(path)]) == status
    assert f"published fingerprints: {prints[0]['table_name']}" in capsys.readouterr().err
    # The rows of one profile are not those of the other.
    assert jobs.main(["verify", "--root", root, "--profile", "full"]) == 1
    assert "row_count" in capsys.readouterr().err
    assert jobs.main(["facts", "--root", root, "--csv", out]) == 0
    facts = {r["fact"]: int(r["value"]) for r in read_report(out, "facts")}
    assert facts["multi_attempt_orders"] == 3000 and facts["failed_only_orders"] == 450
    assert len(read_report(out, "date_ranges")) == 8 and len(read_report(out, "statuses")) == 9
    capsys.readouterr()
    assert jobs.main(["versions", "--root", root]) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == 2


def test_published_facts(shop):
    facts = {r.fact: r.value for r in jobs.fact_report(shop).collect()}
    assert facts == {
        "zero_order_customers": 258, "unsold_products": 25, "customer_1_orders": 752,
        "product_4_movements": 9463, "multi_attempt_orders": 3000, "failed_only_orders": 450,
    }


def test_unknown_profile_exits_with_an_error(spark, tmp_path):
    assert jobs.main(["build", "--root", str(tmp_path), "--profile", "medium"]) == 1


def test_stored_catalog_is_the_contract(spark):
    assert relation_diff(jobs.stored_catalog(spark), COMMERCE.catalog(spark)).isEmpty()


def test_count_contracts_agree(spark, published_digests):
    rows = [(p, t, n) for p, tables in published_digests.items() for t, (n, _) in tables.items()]
    published = spark.createDataFrame(rows, COUNT_SCHEMA)
    ours = expected_counts(spark, [profile_named("small"), profile_named("full")])
    assert relation_diff(published, ours).isEmpty()
    off = published.replace(15000, 15001, "row_count")
    assert relation_diff(off, ours).count() == 2
