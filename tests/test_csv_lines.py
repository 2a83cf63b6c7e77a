import pytest

from cartloom.sources import csv_lines

KIND = "id bigint, name string, price decimal(9,2), day date"


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], KIND).schema


def test_good_and_bad_lines(spark, schema, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,price,day\n1,plain,2.50,2024-01-31\n\n2,\"with, comma\",,\n3,short\n4,x,y,2024-01-01\n5,long,1,2024-01-01,more\nsix,x,1.5,never\n7,,0.1,2024-02-29\n")
    (tmp_path / "b.csv").write_text("id,name,price,day\n8,last,1,2024-01-01\n9,bad,1,2024-13-01")
    parsed = csv_lines.read(spark, str(tmp_path), schema)
    assert sorted((r.id, r.name, str(r.price), str(r.day)) for r in parsed.rows.collect()) == [
        (1, "plain", "2.50", "2024-01-31"), (2, "with, comma", "None", "None"), (7, None, "0.10", "2024-02-29"), (8, "last", "1.00", "2024-01-01")]
    assert parsed.rows.schema == schema
    assert sorted((r.file.rsplit("/", 1)[1], r.line, r.reason, r.text) for r in parsed.rejected.collect()) == [
        ("a.csv", 5, "fields", "3,short"), ("a.csv", 6, "type:price", "4,x,y,2024-01-01"), ("a.csv", 7, "fields", "5,long,1,2024-01-01,more"),
        ("a.csv", 8, "type:id,day", "six,x,1.5,never"), ("b.csv", 3, "type:day", "9,bad,1,2024-13-01")]


def test_numbers_over_splits(spark, schema, tmp_path):
    """A file cut into many splits, several of them in one task."""
    lines = [f"{i},n{i},1,2024-01-01" if i % 50 else f"{i},bad" for i in range(1, 4001)]
    (tmp_path / "big.csv").write_text("\n".join(lines))
    (tmp_path / "other.csv").write_text("1,n,1,2024-01-01\nbad\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        parsed = csv_lines.read(spark, str(tmp_path), schema, header=False)
        got = sorted((r.file.rsplit("/", 1)[1], r.line, r.text) for r in parsed.rejected.collect())
        assert csv_lines.numbered_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == [("big.csv", i, f"{i},bad") for i in range(50, 4001, 50)] + [("other.csv", 2, "bad")]
    assert parsed.rows.count() == 4000 - 80 + 1


def test_wrong_header_and_empty_files(spark, schema, tmp_path):
    (tmp_path / "x.csv").write_text("id,price,name,day\n1,2,3,2024-01-01\n")
    with pytest.raises(ValueError):
        csv_lines.read(spark, str(tmp_path), schema)
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("")
    parsed = csv_lines.read(spark, str(tmp_path / "empty"), schema)
    assert parsed.rows.collect() == [] and parsed.rejected.collect() == []
