import pytest
from pyspark.sql import functions as F

from cartloom.contract import VerificationError, require, verify
from cartloom.contract.commerce import COMMERCE
from cartloom.contract.commerce import verify as verify_commerce
from cartloom.generate import profile_named
from cartloom.operators import mutate

COUNTS = profile_named("small").expected_counts()


def failures(spark, tables, contract=COMMERCE, stored=None):
    report = verify_commerce(spark, tables, COUNTS, contract, stored)
    return {(r["check"], r.subject) for r in report.where("NOT passed").collect()}


def with_update(shop, name, condition, assignments):
    columns = {c: F.expr(e) for c, e in assignments.items()}
    return {**shop, name: mutate.update_where(shop[name], F.expr(condition), columns)}


def test_published_data_passes(spark, shop):
    report = verify_commerce(spark, shop, COUNTS, stored_catalog=COMMERCE.catalog(spark)).cache()
    require(report)
    assert report.count() == 193
    golden = {
        "customers.without_orders": 258, "products.without_items": 25, "products.inactive": 50, "orders.all_payments_failed": 450,
        "orders.success_after_failure": 2700, "orders.without_shipments": 3750, "shipments.delivered": 9000,
        "orders.one_payment": 12000, "orders.several_payments": 3000, "customers.busiest_orders": 752,
    }
    observed = {r.subject: r.observed for r in report.collect()}
    assert {k: observed[k] for k in golden} == golden


def test_inventory_of_rules():
    kinds = [kind for kind, _, _ in COMMERCE.entries()]
    assert {k: kinds.count(k) for k in ("primary_key", "unique", "foreign_key", "check")} == {
        "primary_key": 9, "unique": 2, "foreign_key": 9, "check": 18,
    }


def test_category_cycle_is_caught(spark, shop):
    broken = with_update(shop, "categories", "id = 1", {"parent_id": "33"})
    assert ("hierarchy", "categories.cycle") in failures(spark, broken)


def test_broken_ledger_fixture_is_caught(spark, shop):
    broken = with_update(shop, "inventory_movements", "id = 2", {"quantity_delta": "-9"})
    assert failures(spark, broken) == {("edge_case", "products.net_of_1")}


def test_dropped_reference_is_caught(spark, shop):
    changed = COMMERCE.without_reference("products", "category_id")
    assert failures(spark, shop, changed, COMMERCE.catalog(spark)) == {("rule_inventory", "contract")}


# One corruption per rule: table, row, assignment, and the check that must fail.
CORRUPTIONS = [
    ("customers", "id = 1", {"email": "'  '"}, ("check", "customers.email.nonempty")),
    ("customers", "id = 1", {"email": "repeat('x', 255)"}, ("length", "customers.email.length")),
    ("customers", "id = 1", {"name": "NULL"}, ("not_null", "customers.name")),
    ("customers", "id = 2", {"id": "1"}, ("primary_key", "customers.id")),
    ("customers", "id = 2", {"email": "'customer000001@example.test'"}, ("unique", "customers.email")),
    ("customers", "id = 1", {"created_at": "timestamp'2024-12-31 23:00:00Z'"}, ("chronology", "customers.ordered_before_created")),
    ("customers", "id = 2000", {"created_at": "timestamp'2022-12-31 23:59:59Z'"}, ("date_envelope", "customers.created_at")),
    ("categories", "id = 40", {"parent_id": "77"}, ("foreign_key", "categories.parent_id")),
    ("categories", "id = 33", {"parent_id": "34"}, ("hierarchy", "categories.depth")),
    ("products", "true", {"active": "true"}, ("edge_case", "products.inactive")),
    ("orders", "id = 5", {"status": "'LOST'"}, ("check", "orders.status.one_of")),
    ("orders", "id = 40", {"status": "'PAID'"}, ("cross_table", "shipments.row_and_order_status")),
    ("orders", "id = 30", {"created_at": "created_at + INTERVAL 2 DAYS"}, ("chronology", "payments.created_at_and_order")),
    ("order_items", "id = 7", {"quantity": "quantity + 1"}, ("cross_table", "payments.amount_and_order_total")),
    ("order_items", "order_id = 1", {"order_id": "2"}, ("cross_table", "orders.without_items")),
    ("order_items", "id = 7", {"product_id": "0"}, ("foreign_key", "order_items.product_id")),
    ("payments", "order_id = 1", {"order_id": "2"}, ("cross_table", "orders.without_payments")),
    ("shipments", "order_id = 25", {"status": "'DELIVERED'", "delivered_at": "shipped_at"}, ("cross_table", "shipments.status_of_shipped_order")),
    ("order_status_history", "order_id = 10 AND status = 'PAID'", {"changed_at": "changed_at - INTERVAL 9 MINUTES"}, ("chronology", "order_status_history.equal_times")),
    ("order_status_history", "order_id = 10 AND status = 'PAID'", {"changed_at": "changed_at - INTERVAL 1 DAY"}, ("chronology", "order_status_history.before_order")),
    ("order_status_history", "order_id = 8 AND status = 'PAID'", {"status": "'PENDING'"}, ("cross_table", "payments.refunded_and_paid")),
    ("order_status_history", "order_id = 40 AND status = 'COMPLETED'", {"status": "'SHIPPED'"}, ("cross_table", "order_status_history.last_status")),
    ("order_status_history", "order_id = 1", {"status": "'PAID'"}, ("cross_table", "order_status_history.first_status")),
]


def test_every_corruption_fails_its_check(spark, shop):
    """One corruption per table and round, so that few reports cover all rules."""
    waiting = list(CORRUPTIONS)
    while waiting:
        tables, expected, later = dict(shop), set(), []
        for corruption in waiting:
            name, condition, assignments, check = corruption
            if tables[name] is not shop[name]:
                later.append(corruption)
                continue
            tables[name] = with_update(shop, name, condition, assignments)[name]
            expected.add(check)
        assert expected - failures(spark, tables) == set()
        waiting = later


def test_schema_and_table_set(spark, shop):
    tables = {n: df for n, df in shop.items() if n != "shipments"}
    tables["products"] = shop["products"].withColumn("price", F.col("price").cast("double"))
    tables["extra"] = shop["orders"]
    report = verify.schema_report(spark, COMMERCE, tables)
    bad = {(r["check"], r.subject) for r in report.where("NOT passed").collect()}
    assert bad == {("table_set", "shipments"), ("table_set", "extra"), ("column", "products.price")}
    with pytest.raises(VerificationError, match="products.price"):
        require(report)


def test_empty_tables_fail_without_an_error(spark, shop):
    found = failures(spark, {name: df.limit(0) for name, df in shop.items()})
    assert {("row_count", "orders"), ("edge_case", "products.net_of_1"), ("hierarchy", "categories.depth")} <= found
    assert {("distribution", "orders.season_ppm"), ("distribution", "orders.first_tenth_of_customers_ppm")} <= found


def test_shares_are_compared_exactly(spark, shop):
    """A share just above its bound passes although the reported value is rounded down to it."""
    df = spark.range(1_000_001 * 10).select((F.col("id") < 6_000_007).alias("hit"))
    part, whole = F.count_if("hit"), F.count(F.lit(1))
    ppm = (part.cast("decimal(20,0)") * 1_000_000 / whole).cast("bigint")
    rows = verify.measured(df, [verify.Measure("share", "s", ppm, "> 600000", part * 10 > whole * 6)]).first()
    assert rows.observed == 600_000 and rows.passed
    december = with_update(shop, "orders", "id <= 300", {"created_at": "timestamp'2024-01-02 00:00:00Z'"})
    assert ("distribution", "orders.season_ppm") in failures(spark, december)


def test_columns_are_checked_on_metadata_and_rows(spark, shop):
    tables = dict(shop)
    tables["products"] = shop["products"].withColumn("price", F.col("price").cast("double")).drop("active")
    tables["customers"] = with_update(shop, "customers", "id < 4", {"name": "NULL"})["customers"]
    report = {(r.table_name, r.column_name): r for r in verify.column_report(COMMERCE, tables).collect()}
    assert len(report) == sum(len(t.columns) for t in COMMERCE.tables)
    bad = {k for k, r in report.items() if not r.passed}
    assert bad == {("products", "price"), ("products", "active"), ("products", "created_at"), ("customers", "name")}
    assert report["customers", "name"].nulls == 3 and report["shipments", "delivered_at"].nulls == 2250


def test_null_condition_fails_a_check_but_passes_a_row_rule(spark):
    df = spark.createDataFrame([(1, None)], "id bigint, v int")
    rows = verify.measured(df, [
        verify.Measure("row rule", "v > 0", verify.violations("v > 0")),
        verify.Measure("assertion", "max v", F.max("v"), "= 1"),
    ]).collect()
    assert [r.passed for r in rows] == [True, False]
