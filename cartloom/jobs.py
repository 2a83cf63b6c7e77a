"""Command line: build, verify, restore and report on published snapshots.

    spark-submit cartloom/jobs.py build   --root <folder> --profile small [--times 10] [--namespace <text>]
    spark-submit cartloom/jobs.py build   --root <folder> --profile all      each profile in its own subfolder
    spark-submit cartloom/jobs.py verify  --root <folder> --profile small [--golden <digests.csv>]
    spark-submit cartloom/jobs.py restore --root <folder> --profile small --version <version>
    spark-submit cartloom/jobs.py versions|fingerprint|facts --root <folder> [--csv <folder>]
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cartloom.contract.commerce import COMMERCE, verify  # noqa: E402
from cartloom.contract.verify import VerificationError  # noqa: E402
from cartloom.generate import PROFILES, Generator, Profile, profile_named  # noqa: E402
from cartloom.generate.profile import DEFAULT_NAMESPACE  # noqa: E402
from cartloom.generate.tables import HOT_CUSTOMER, HOT_PRODUCT  # noqa: E402
from cartloom.operators import fingerprint, keys  # noqa: E402
from cartloom.operators.profiling import date_ranges, facts, frequencies, union_all  # noqa: E402
from cartloom.session import RECOMMENDED  # noqa: E402
from cartloom.sources import files, snapshot  # noqa: E402

STORED_CATALOG = Path(__file__).resolve().parent / "contract" / "commerce_catalog.csv"
CATALOG_SCHEMA = "kind string, name string, definition string"
GOLDEN_SCHEMA = "table_name string, row_count bigint, lane_a decimal(38,0), lane_b decimal(38,0)"


def stored_catalog(spark: SparkSession) -> DataFrame:
    """The reviewed rule inventory that ships with the package; read on the driver, it is a short text."""
    import csv

    with STORED_CATALOG.open(newline="") as lines:
        rows = [tuple(r) for r in list(csv.reader(lines))[1:]]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def verifier(spark: SparkSession, profile: Profile) -> Callable[[dict[str, DataFrame]], DataFrame]:
    counts = profile.expected_counts()
    return lambda tables: verify(spark, tables, counts, COMMERCE, stored_catalog(spark))


def build(spark: SparkSession, root: str, profile: Profile) -> str:
    """Generate, stage, verify and publish one profile; returns the new version."""
    tables = Generator(profile).build(spark)
    return snapshot.publish(
        spark, tables, root, verifier(spark, profile), profile.name,
        snapshot.CLUSTERING_OF_GENERATED, profile.expected_counts(),
    )


def require_golden(tables: dict[str, DataFrame], golden: DataFrame) -> None:
    """Raise with the names of the tables whose fingerprint is not the published one."""
    changed = sorted(r.table_name for r in snapshot.golden_mismatches(tables, golden).collect())
    if changed:
        raise VerificationError(f"content differs from the published fingerprints: {', '.join(changed)}")


def fact_report(tables: dict[str, DataFrame]) -> DataFrame:
    """The named counts of the commerce tables."""
    attempts = tables["payments"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("attempts"), F.bool_and(F.col("status") == "FAILED").alias("failed_only")
    )
    return facts({
        "zero_order_customers": keys.without_children(tables["customers"].select("id"), "id", tables["orders"], "customer_id"),
        "unsold_products": keys.without_children(tables["products"].select("id"), "id", tables["order_items"], "product_id"),
        f"customer_{HOT_CUSTOMER}_orders": tables["orders"].where(F.col("customer_id") == HOT_CUSTOMER),
        f"product_{HOT_PRODUCT}_movements": tables["inventory_movements"].where(F.col("product_id") == HOT_PRODUCT),
        "multi_attempt_orders": attempts.where("attempts > 1"),
        "failed_only_orders": attempts.where("failed_only"),
    })


def status_report(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        frequencies(tables[name], "status").select(F.lit(name).alias("table_name"), "status", "row_count")
        for name in ("orders", "payments")
    ])


def _show(df: DataFrame, order: list[str], folder: str | None, name: str) -> None:
    if folder:
        files.write_csv_report(df, f"{folder}/{name}", order)
    else:
        print("\t".join(df.columns))
        for row in df.orderBy(*order).toLocalIterator():
            print("\t".join("" if v is None else str(v) for v in row))


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cartloom")
    parser.add_argument("command", choices=["build", "verify", "restore", "versions", "fingerprint", "facts"])
    parser.add_argument("--root", required=True)
    parser.add_argument("--profile", default="small")
    parser.add_argument("--times", type=int, default=1)
    parser.add_argument("--namespace", default=DEFAULT_NAMESPACE)
    parser.add_argument("--version")
    parser.add_argument("--golden", help="CSV of table_name,row_count,lane_a,lane_b (as the fingerprint command writes it) that verify compares with")
    parser.add_argument("--csv")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "build" and args.profile == "all":
        for name in PROFILES:
            version = build(spark, f"{args.root}/{name}", profile_named(name, args.namespace))
            print(f"published {name} as {version}")
        return
    profile = profile_named(args.profile, args.namespace)
    if args.times > 1:
        profile = profile.times(args.times)
    if args.command == "build":
        print(f"published {profile.name} as {build(spark, args.root, profile)}")
    elif args.command == "verify":
        tables = snapshot.load(spark, args.root, verifier(spark, profile))
        if args.golden:
            require_golden(tables, files.read_csv(spark, args.golden, GOLDEN_SCHEMA))
        print(f"{profile.name} passes all checks")
    elif args.command == "restore":
        snapshot.restore(spark, args.root, args.version, verifier(spark, profile))
        print(f"{args.version} is current")
    elif args.command == "versions":
        _show(snapshot.publications(spark, args.root), ["sequence"], args.csv, "versions")
    elif args.command == "fingerprint":
        prints = fingerprint.of_tables(snapshot.load(spark, args.root), fingerprint.summed)
        _show(prints, ["table_name"], args.csv, "fingerprints")
    else:
        tables = snapshot.load(spark, args.root)
        _show(date_ranges(tables), ["column_name"], args.csv, "date_ranges")
        _show(status_report(tables), ["table_name", "status"], args.csv, "statuses")
        _show(fact_report(tables), ["fact"], args.csv, "facts")


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    builder = SparkSession.builder.appName("cartloom")
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        run(spark, args)
    except (VerificationError, snapshot.SnapshotError, ValueError) as error:
        print(f"FAILED: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
