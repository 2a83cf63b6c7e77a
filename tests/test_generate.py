import pytest
from pyspark.sql import functions as F

from cartloom.functions.draws import keyed_hash
from cartloom.generate import Generator, Profile, profile_named
from cartloom.operators.ordered import dense_row_number
from tests.conftest import ordered_digest


def test_hash_vectors(spark, published_namespace):
    def h(k, stream):
        return keyed_hash(F.lit(k), stream, published_namespace)

    row = spark.range(1).select(
        h(1, "name"), h(1, "price"), h(1, "order-date"), h(11, "product"), h(None, "name")
    ).first()
    assert list(row) == [2684278175, 1821009683, 651205176, 2722670516, None]


@pytest.mark.parametrize("profile", ["small", "full"])
def test_published_digests(spark, published_namespace, published_digests, profile):
    tables = Generator(profile_named(profile, published_namespace)).build(spark)
    actual = {name: ordered_digest(df) for name, df in tables.items()}
    assert actual == published_digests[profile]


def test_digests_do_not_depend_on_the_session_time_zone(spark, published_namespace, published_digests):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        tables = Generator(profile_named("small", published_namespace)).build(spark)
        actual = {name: ordered_digest(df) for name, df in tables.items()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert actual == published_digests["small"]


@pytest.mark.parametrize("orders", [1_000, 1_037])
def test_expected_counts_match_rows(spark, orders):
    profile = Profile("odd", customers=200, products=60, orders=orders, movements=500)
    tables = Generator(profile).build(spark)
    assert {name: df.count() for name, df in tables.items()} == profile.expected_counts()


def test_unknown_profile_is_an_error():
    with pytest.raises(ValueError):
        profile_named("medium")


def test_closed_forms_equal_joins_and_numbering(spark, shop, published_namespace):
    g = Generator(profile_named("small", published_namespace))
    joined = g.order_items(shop["orders"], shop["products"])
    assert joined.exceptAll(shop["order_items"]).isEmpty() and joined.count() == 45_000

    totals = shop["order_items"].groupBy("order_id").agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("amount"))
    paid = g.payments(shop["orders"], totals)
    assert paid.exceptAll(shop["payments"]).isEmpty() and paid.count() == 18_000

    for table, order in [("order_status_history", ["order_id", "changed_at"]), ("shipments", ["order_id"])]:
        numbered = dense_row_number(shop[table], order, "n", task_rows=3_000)
        assert numbered.where("n <> id").isEmpty()


def test_generation_is_shuffle_free(spark, shop, published_namespace):
    for name, df in Generator(profile_named("small", published_namespace)).build(spark).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan, name


def test_rows_do_not_change_with_the_factor(spark):
    base = profile_named("full")
    plain = Generator(base)
    ids = spark.range(1, 200)
    for factor in (20, 6_000, 234_000):
        g = Generator(base.times(factor))
        assert (g.profile.hash_digits, g.profile.email_digits, g.profile.ledger_steps) == (8, 6, 10_000)
        for method in ("customers", "products"):
            assert getattr(g, method)(ids).collect() == getattr(plain, method)(ids).collect()
        last = spark.range(g.profile.customers - 5, g.profile.customers + 1)
        assert {r.email for r in g.customers(last).collect()} == {f"customer{i:06d}@example.test" for i in range(g.profile.customers - 5, g.profile.customers + 1)}


@pytest.mark.parametrize("wide", [False, True])
def test_the_largest_profile_generates(spark, wide):
    big = profile_named("full").times(234_000)
    big = big.wide() if wide else big
    g = Generator(big)
    ids = spark.range(big.movements - 50_000, big.movements)
    span = g.inventory_movements(ids).agg(F.countDistinct("product_id"), F.max("product_id"), F.min("product_id")).first()
    assert span[0] > (30_000 if wide else 8_000) and 0.9 * big.products < span[1] <= big.products and span[2] >= 4
    orders = g.orders(spark.range(big.orders - 100, big.orders))
    assert g.payments(orders).count() == 120 and g.order_items(orders).where("product_id > %d" % big.products).isEmpty()


def test_wide_ledger_draw_is_exact(spark):
    profile = profile_named("full").times(1_000).wide()
    g = Generator(profile)
    rows = spark.range(1, 400).select("id", g.draw(F.col("id"), "inventory-product").alias("q"), g.ledger_product(F.col("id")).alias("p")).collect()
    steps = profile.ledger_steps
    assert all(r.p == (4 if r.id % 5 == 0 else (r.q % steps) ** 2 * (profile.products - 4) // steps**2 + 4) for r in rows)


def test_small_profiles_are_refused_as_a_whole(spark):
    with pytest.raises(ValueError, match="too small"):
        Generator(Profile("tiny", customers=3, products=2, orders=1, movements=1)).build(spark)
    few = Generator(Profile("tiny", customers=3, products=2, orders=1, movements=1))
    assert few.orders(spark.range(1, 2)).count() == 1


def test_golden_facts(shop):
    status = {r.status: r["count"] for r in shop["orders"].groupBy("status").count().collect()}
    assert status == {"PENDING": 750, "CANCELLED": 750, "PAID": 2250, "SHIPPED": 2250, "COMPLETED": 9000}
    paid = {r.status: r["count"] for r in shop["payments"].groupBy("status").count().collect()}
    assert paid == {"SUCCEEDED": 13500, "FAILED": 3450, "PENDING": 750, "REFUNDED": 300}
    assert shop["products"].where("NOT active").count() == 50
    assert shop["shipments"].where("status = 'DELIVERED'").count() == 9000
    assert shop["inventory_movements"].where("product_id = 4").count() == 9463
    assert shop["orders"].where("customer_id = 1").count() == 752
