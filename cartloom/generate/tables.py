"""The nine commerce tables as shuffle-free projections of an id sequence.

Ids come from ``spark.range`` or from any DataFrame with a dense ``id`` column. Prices, totals and
dense child ids are closed forms of the parent id, so no table needs a join, an aggregate or a global
window; a task can produce any slice alone.
"""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.draws import instant, keyed_hash, later, padded, pick, quotient, weighted
from cartloom.generate import rules
from cartloom.generate.profile import CATEGORIES, Profile
from cartloom.operators.skew import lookup


def _epoch(*parts: int) -> int:
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp())


# Word lists, calendar and fixture rows.
FIRST_NAMES = ["Ada", "Deniz", "Maya", "Emre", "Lina", "Can", "Ece", "Noah"]
ROOT_CATEGORIES = ["Electronics", "Home", "Clothing", "Outdoors"]
YEAR_2023 = _epoch(2023, 1, 1)
YEAR_2024 = _epoch(2024, 1, 1)
SEASON_START = _epoch(2024, 10, 1)
TIE_MOMENT = _epoch(2024, 12, 1, 12)
SECONDS_2023 = 365 * 86_400
SECONDS_2024 = 366 * 86_400
HALF_HOUR = 1_800
HALF_HOURS_YEAR_BEFORE_SEASON = 13_152
HALF_HOURS_SEASON = 4_416
TIED_ORDERS = (1, 2)
HOT_CUSTOMER = 1
HOT_PRODUCT = 4
# (product, delta, reason, day of January 2024) of ledger rows 1..6; row 7 is the last product's.
LEDGER_FIXTURES = [
    (1, 10, "RESTOCK", 1),
    (1, -10, "SALE", 2),
    (2, 10, "RESTOCK", 1),
    (2, -9, "SALE", 2),
    (3, 10, "RESTOCK", 1),
    (3, -11, "ADJUSTMENT", 2),
]
LAST_PRODUCT_FIXTURE = (25, "RESTOCK", 1)
IDS_PER_TASK = 500_000
MAX_TASKS = 50_000


def sequence(spark: SparkSession, last: int, first: int = 1) -> DataFrame:
    """Dense ids first..last in ascending ranges, split so that a task stays short at any size."""
    rows = max(0, last - first + 1)
    per_task = max(IDS_PER_TASK, rows // MAX_TASKS)
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows // per_task))
    return spark.range(first, last + 1, numPartitions=tasks)


def _square(draw: Column) -> Column:
    """Exact square of a draw below 2^26, with the hash evaluated once."""
    return F.pow(draw, F.lit(2)).cast("bigint")


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") / F.lit(100)).cast("decimal(12,2)")


class Generator:
    """Column rules of one profile; each table method maps parent ids to rows."""

    def __init__(self, profile: Profile):
        self.profile = profile

    def draw(self, key: Column, stream: str) -> Column:
        return keyed_hash(key, stream, self.profile.namespace, self.profile.hash_digits)

    # -- independent tables ---------------------------------------------------------------------

    def customers(self, ids: DataFrame) -> DataFrame:
        i = F.col("id")
        return ids.select(
            i,
            F.concat(F.lit("customer"), padded(i, self.profile.email_digits), F.lit("@example.test")).alias("email"),
            F.concat(pick(FIRST_NAMES, self.draw(i, "name") % len(FIRST_NAMES)), F.lit(" Customer "), i).alias("name"),
            instant(YEAR_2023, self.draw(i, "customer-date") % SECONDS_2023).alias("created_at"),
        )

    def categories(self, ids: DataFrame) -> DataFrame:
        """Levels of 4, 12, 16 and 8 nodes."""
        i = F.col("id")
        parent = (
            F.when(i <= 4, F.lit(None).cast("bigint"))
            .when(i <= 16, quotient(i - 5, 3) + 1)
            .when(i <= 32, (i - 17) % 12 + 5)
            .otherwise(i - 16)
        )
        roots = pick(ROOT_CATEGORIES, F.least(i, F.lit(len(ROOT_CATEGORIES)).cast("bigint")) - 1)
        label = F.when(i <= 4, roots).otherwise(F.concat(F.lit("Category "), padded(i, 2)))
        return ids.select(i, parent.alias("parent_id"), label.alias("name"))

    def product_category(self, product: Column) -> Column:
        spread = self.draw(product, "category")
        bands = [(bound, spread % count + first) for bound, first, count in rules.CATEGORY_BANDS]
        return weighted(self.draw(product, "category-skew") % 10, bands[:-1], bands[-1][1])

    def product_cents(self, product: Column) -> Column:
        """List price in cents: quadratic skew towards low prices, 5.00 to 1004.80."""
        drawn = _square(self.draw(product, "price") % rules.PRICE_STEPS)
        return quotient(drawn, rules.PRICE_DIVISOR) + rules.LOWEST_CENTS

    def products(self, ids: DataFrame) -> DataFrame:
        i = F.col("id")
        return ids.select(
            i,
            self.product_category(i).alias("category_id"),
            F.concat(F.lit("Product "), padded(i, self.profile.product_digits)).alias("name"),
            _money(self.product_cents(i)).alias("price"),
            (i % 10 != 0).alias("active"),
            instant(YEAR_2023, self.draw(i, "product-date") % SECONDS_2023).alias("created_at"),
        )

    def order_status(self, order: Column) -> Column:
        return weighted(order % rules.PERIOD, rules.STATUS_CUTOFFS, rules.STATUS_REST)

    def order_customer(self, order: Column) -> Column:
        """A fixed hot customer, then a hot tenth, then a range that leaves the last tenth empty."""
        p = self.profile
        spread = self.draw(order, "customer")
        bands = [(bound, spread % max(1, p.customers * tenths // 10 - 1) + 2) for bound, tenths in rules.CUSTOMER_BANDS]
        drawn = weighted(self.draw(order, "customer-skew") % 10, bands[:-1], bands[-1][1])
        hot = order.isin(*TIED_ORDERS) | (order % rules.HOT_ORDER_EVERY == 0)
        return F.when(hot, F.lit(HOT_CUSTOMER).cast("bigint")).otherwise(drawn)

    def order_moment(self, order: Column) -> Column:
        """A quarter of the orders before the season, the rest inside it; two orders tie on purpose."""
        slot = self.draw(order, "order-date")
        return (
            F.when(order.isin(*TIED_ORDERS), instant(TIE_MOMENT))
            .when(order % 4 == 0, instant(YEAR_2024, slot % HALF_HOURS_YEAR_BEFORE_SEASON * HALF_HOUR))
            .otherwise(instant(SEASON_START, slot % HALF_HOURS_SEASON * HALF_HOUR))
        )

    def orders(self, ids: DataFrame) -> DataFrame:
        i = F.col("id")
        return ids.select(
            i,
            self.order_customer(i).alias("customer_id"),
            self.order_status(i).alias("status"),
            self.order_moment(i).alias("created_at"),
        )

    def ledger_product(self, movement: Column) -> Column:
        p = self.profile
        steps, spread = p.ledger_steps, max(0, p.products - 4)
        q = self.draw(movement, "inventory-product") % steps
        if steps * steps * max(1, spread) < 2**63:
            drawn = quotient(_square(q) * spread, steps * steps)
        else:  # the same quotient, in numbers that hold the product
            wide = q.cast("decimal(13,0)")
            product = wide * wide * F.lit(spread).cast("decimal(12,0)")
            drawn = F.call_function("div", product, F.lit(Decimal(steps * steps)))
        return F.when(movement % 5 == 0, F.lit(HOT_PRODUCT).cast("bigint")).otherwise(drawn + HOT_PRODUCT)

    def inventory_movements(self, ids: DataFrame) -> DataFrame:
        """Signed ledger; the first seven rows are fixtures laid over the same id sequence."""
        i = F.col("id")
        last_delta, last_reason, last_day = LAST_PRODUCT_FIXTURE
        fixtures = [*LEDGER_FIXTURES, (self.profile.products, last_delta, last_reason, last_day)]
        restock = i % 10 < 4

        def overlay(position: int, drawn: Column, to_value) -> Column:
            chosen = None
            for row, fixture in enumerate(fixtures, start=1):
                value = to_value(fixture[position])
                chosen = F.when(i == row, value) if chosen is None else chosen.when(i == row, value)
            return chosen.otherwise(drawn)

        delta = F.when(restock, self.draw(i, "restock") % 40 + 1).otherwise(-(self.draw(i, "sale") % 12 + 1))
        moment = instant(YEAR_2024, self.draw(i, "movement-date") % SECONDS_2024)
        return ids.select(
            i,
            overlay(0, self.ledger_product(i), lambda v: F.lit(v).cast("bigint")).alias("product_id"),
            overlay(1, delta.cast("int"), lambda v: F.lit(v).cast("int")).alias("quantity_delta"),
            overlay(2, F.when(restock, "RESTOCK").otherwise("SALE"), F.lit).alias("reason"),
            overlay(3, moment, lambda day: instant(YEAR_2024 + (day - 1) * 86_400)).alias("created_at"),
        )

    # -- children of orders ---------------------------------------------------------------------

    def item_product(self, order: Column, slot: Column) -> Column:
        """Seven of ten draws fall on the first tenth of products; the last twentieth never sells."""
        p = self.profile
        line = order * 10 + slot
        spread = self.draw(line, "product")
        bands = [(bound, spread % max(1, p.products * hundredths // 100) + 1) for bound, hundredths in rules.PRODUCT_BANDS]
        return weighted(self.draw(line, "product-skew") % 10, bands[:-1], bands[-1][1])

    def item_quantity(self, order: Column, slot: Column) -> Column:
        line = order * 10 + slot
        single = self.draw(line, "quantity") % 10 < 8
        return F.when(single, F.lit(1)).otherwise((self.draw(line, "quantity-large") % 4 + 2).cast("int"))

    def item_cents(self, order: Column, slot: Column, list_cents: Column) -> Column:
        """Sale price in cents: 80 to 110 percent of the list price, half a cent rounded up."""
        percent = self.draw(order * 10 + slot, "discount") % rules.PERCENTS + rules.LOWEST_PERCENT
        return quotient(list_cents * percent + 50, 100)

    def order_items(self, orders: DataFrame, products: DataFrame | None = None) -> DataFrame:
        """One to five lines per order.

        Without ``products`` the list price is recomputed from the drawn product id and nothing is
        shuffled. With it, the price comes from a lookup join on the drawn id.
        """
        slot = F.col("slot")
        order = F.col("order_id")
        n = F.col("order_id") - 1
        residue = n % 5
        lines = orders.select(
            F.col("id").alias("order_id"),
            F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("id") % 5 + 1)).alias("slot"),
        ).withColumn("product_id", self.item_product(order, slot))
        if products is None:
            priced = lines.withColumn("list_cents", self.product_cents(F.col("product_id")))
        else:
            cents = (F.col("price") * 100).cast("bigint")
            catalog = products.select(F.col("id").alias("product_id"), cents.alias("list_cents"))
            priced = lookup(lines, catalog, "product_id")
        before = n + quotient(n, 5) * 10 + quotient(residue * (residue + 1), 2)
        return priced.select(
            (before + slot).alias("id"),
            "order_id",
            "product_id",
            self.item_quantity(order, slot).alias("quantity"),
            _money(self.item_cents(order, slot, F.col("list_cents"))).alias("unit_price"),
        )

    def order_amount(self, order: Column) -> Column:
        """Order total from the id alone, by folding the line rules over the slots of the order."""

        def add_line(cents: Column, slot: Column) -> Column:
            price = self.item_cents(order, slot, self.product_cents(self.item_product(order, slot)))
            return cents + price * self.item_quantity(order, slot)

        slots = F.sequence(F.lit(1).cast("bigint"), order % 5 + 1)
        return _money(F.aggregate(slots, F.lit(0).cast("bigint"), add_line))

    def payments(self, orders: DataFrame, totals: DataFrame | None = None) -> DataFrame:
        """One attempt per order, two for every fifth; each carries the whole order amount.

        ``totals`` (order_id, amount) replaces the recomputed amount by a join on the order id.
        """
        o = F.col("id")
        amount = self.order_amount(o) if totals is None else F.col("amount")
        source = orders if totals is None else orders.join(
            totals.select(F.col("order_id").alias("id"), F.col("amount").cast("decimal(12,2)").alias("amount")), "id"
        )
        attempts = F.when(o % rules.RETRY_EVERY == 0, 2).otherwise(1)
        exploded = source.select(
            o,
            "status",
            "created_at",
            amount.alias("amount"),
            weighted(self.draw(o, "provider") % 10, rules.PROVIDER_BANDS[:-1], rules.PROVIDER_BANDS[-1][1]).alias("provider"),
        ).select("*", F.explode(F.sequence(F.lit(1), attempts)).alias("attempt"))
        cancelled = F.col("status") == "CANCELLED"
        outcome = (
            F.when((F.col("attempt") == 1) & (o % rules.RETRY_EVERY == 0), "FAILED")
            .when(F.col("status") == "PENDING", "PENDING")
            .when(cancelled & (o % rules.PERIOD).isin(*rules.REFUNDED_RESIDUES), "REFUNDED")
            .when(cancelled, "FAILED")
            .otherwise("SUCCEEDED")
        )
        return exploded.select(
            (o - 1 + quotient(o - 1, rules.RETRY_EVERY) + F.col("attempt")).alias("id"),
            o.alias("order_id"),
            outcome.alias("status"),
            "amount",
            "provider",
            later(F.col("created_at"), F.col("attempt") * (rules.ATTEMPT_MINUTES * 60)).alias("created_at"),
        )

    def shipments(self, orders: DataFrame) -> DataFrame:
        o, done = F.col("id"), F.col("status") == "COMPLETED"
        per_period = rules.rows_per_period(rules.shipments_of)
        first_shipped = rules.PERIOD - per_period
        number = quotient(o, rules.PERIOD) * per_period + o % rules.PERIOD - (first_shipped - 1)
        return orders.where(F.col("status").isin("SHIPPED", "COMPLETED")).select(
            number.alias("id"),
            o.alias("order_id"),
            F.when(done, "DELIVERED").otherwise("SHIPPED").alias("status"),
            later(F.col("created_at"), 86_400).alias("shipped_at"),
            F.when(done, later(F.col("created_at"), 3 * 86_400)).alias("delivered_at"),
        )

    def order_status_history(self, orders: DataFrame) -> DataFrame:
        """Up to five events per order, expanded in one pass."""
        o, status = F.col("id"), F.col("status")
        fulfilled = status.isin("PAID", "SHIPPED", "COMPLETED")
        refunded = (o % rules.PERIOD).isin(*rules.REFUNDED_RESIDUES)
        branches = [
            ("PENDING", 0, F.lit(True)),
            ("PENDING", rules.RETRY_MINUTE, o % rules.RETRY_EVERY == 0),
            ("PAID", rules.PAID_MINUTE, fulfilled | refunded),
            ("CANCELLED", rules.CANCELLED_MINUTE, status == "CANCELLED"),
            ("SHIPPED", rules.SHIPPED_MINUTE, status.isin("SHIPPED", "COMPLETED")),
            ("COMPLETED", rules.COMPLETED_MINUTE, status == "COMPLETED"),
        ]
        events = F.array_compact(
            F.array(*[
                F.when(keep, F.struct(F.lit(name).alias("status"), F.lit(minute).alias("minute")))
                for name, minute, keep in branches
            ])
        )
        per_order = lambda order: len(rules.events_of(order))
        before = F.element_at(
            F.array(*[F.lit(n).cast("bigint") for n in rules.rows_before(per_order)]),
            ((o - 1) % rules.PERIOD + 1).cast("int"),
        )
        base = quotient(o - 1, rules.PERIOD) * rules.rows_per_period(per_order) + before
        return orders.select(
            o, "created_at", base.alias("before"), F.posexplode(events).alias("position", "event")
        ).select(
            (F.col("before") + F.col("position") + 1).alias("id"),
            o.alias("order_id"),
            F.col("event.status").alias("status"),
            later(F.col("created_at"), F.col("event.minute") * 60).alias("changed_at"),
        )

    # -- all tables -----------------------------------------------------------------------------

    def build(self, spark: SparkSession) -> dict[str, DataFrame]:
        """All nine tables from ``spark.range``."""
        p = self.profile
        p.require_size()
        orders = self.orders(sequence(spark, p.orders))
        return {
            "customers": self.customers(sequence(spark, p.customers)),
            "categories": self.categories(sequence(spark, CATEGORIES)),
            "products": self.products(sequence(spark, p.products)),
            "orders": orders,
            "order_items": self.order_items(orders),
            "payments": self.payments(orders),
            "shipments": self.shipments(orders),
            "order_status_history": self.order_status_history(orders),
            "inventory_movements": self.inventory_movements(sequence(spark, p.movements)),
        }
