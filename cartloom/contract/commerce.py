"""The nine-table commerce contract and its cross-table checks."""

from __future__ import annotations

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.contract.model import Check, Column, Contract, Reference, Table
from cartloom.contract.verify import SOME, Measure, measured, structural
from cartloom.functions.draws import instant
from cartloom.generate.tables import HOT_CUSTOMER, SEASON_START, YEAR_2023, _epoch
from cartloom.operators import hierarchy
from cartloom.operators.profiling import timestamp_columns, union_all

# Types, lengths and allowed words.
MONEY = "decimal(12,2)"
ORDER_STATUSES = ["PENDING", "PAID", "SHIPPED", "COMPLETED", "CANCELLED"]
PAYMENT_STATUSES = ["PENDING", "SUCCEEDED", "FAILED", "REFUNDED"]
SHIPMENT_STATUSES = ["PENDING", "SHIPPED", "DELIVERED"]
MOVEMENT_REASONS = ["RESTOCK", "SALE", "RETURN", "ADJUSTMENT"]
ENVELOPE_END = _epoch(2025, 1, 4)
TREE_DEPTH = 4
BUSY_LEDGER = 1000


def _id() -> Column:
    return Column("id", "bigint")


def _text(name: str, length: int) -> Column:
    return Column(name, "string", max_length=length)


COMMERCE = Contract((
    Table(
        "customers",
        (_id(), _text("email", 254), _text("name", 200), Column("created_at", "timestamp")),
        uniques=(("email",),),
        checks=(Check.nonempty("email"), Check.nonempty("name")),
    ),
    Table(
        "categories",
        (_id(), Column("parent_id", "bigint", nullable=True), _text("name", 120)),
        references=(Reference("parent_id", "categories"),),
        checks=(Check.nonempty("name"), Check("parent_id.not_self", "parent_id <> id")),
    ),
    Table(
        "products",
        (
            _id(), Column("category_id", "bigint"), _text("name", 200), Column("price", MONEY),
            Column("active", "boolean"), Column("created_at", "timestamp"),
        ),
        references=(Reference("category_id", "categories"),),
        checks=(Check.nonempty("name"), Check.finite_amount("price")),
    ),
    Table(
        "orders",
        (_id(), Column("customer_id", "bigint"), _text("status", 20), Column("created_at", "timestamp")),
        references=(Reference("customer_id", "customers"),),
        checks=(Check.one_of("status", ORDER_STATUSES),),
    ),
    Table(
        "order_items",
        (
            _id(), Column("order_id", "bigint"), Column("product_id", "bigint"), Column("quantity", "int"),
            Column("unit_price", MONEY),
        ),
        references=(Reference("order_id", "orders"), Reference("product_id", "products")),
        checks=(Check.compare("quantity", "> 0", "positive"), Check.finite_amount("unit_price")),
    ),
    Table(
        "payments",
        (
            _id(), Column("order_id", "bigint"), _text("status", 20), Column("amount", MONEY),
            _text("provider", 40), Column("created_at", "timestamp"),
        ),
        references=(Reference("order_id", "orders"),),
        checks=(
            Check.one_of("status", PAYMENT_STATUSES), Check.finite_amount("amount"), Check.nonempty("provider"),
        ),
    ),
    Table(
        "shipments",
        (
            _id(), Column("order_id", "bigint"), _text("status", 20),
            Column("shipped_at", "timestamp", nullable=True), Column("delivered_at", "timestamp", nullable=True),
        ),
        uniques=(("order_id",),),
        references=(Reference("order_id", "orders"),),
        checks=(
            Check.one_of("status", SHIPMENT_STATUSES),
            Check(
                "dates_follow_status",
                "CASE status WHEN 'PENDING' THEN shipped_at IS NULL AND delivered_at IS NULL"
                " WHEN 'SHIPPED' THEN shipped_at IS NOT NULL AND delivered_at IS NULL"
                " WHEN 'DELIVERED' THEN shipped_at IS NOT NULL AND delivered_at IS NOT NULL"
                " AND delivered_at >= shipped_at ELSE status IS NULL END",
            ),
        ),
    ),
    Table(
        "order_status_history",
        (_id(), Column("order_id", "bigint"), _text("status", 20), Column("changed_at", "timestamp")),
        references=(Reference("order_id", "orders"),),
        checks=(Check.one_of("status", ORDER_STATUSES),),
    ),
    Table(
        "inventory_movements",
        (
            _id(), Column("product_id", "bigint"), Column("quantity_delta", "int"), _text("reason", 30),
            Column("created_at", "timestamp"),
        ),
        references=(Reference("product_id", "products"),),
        checks=(
            Check.compare("quantity_delta", "<> 0", "nonzero"),
            Check.one_of("reason", MOVEMENT_REASONS),
            Check(
                "sign_follows_reason",
                "CASE WHEN reason IN ('RESTOCK', 'RETURN') THEN quantity_delta > 0"
                " WHEN reason = 'SALE' THEN quantity_delta < 0 ELSE reason = 'ADJUSTMENT' END",
            ),
        ),
    ),
))


def _ppm(part: Expr, whole: Expr) -> Expr:
    """Share in parts per million, for the report; the exact comparison is made on the counts."""
    return F.try_divide(part.cast("decimal(20,0)") * 1_000_000, whole).cast("bigint")


def single_table_measures(tables: dict[str, DataFrame]) -> dict[str, list[Measure]]:
    """Date envelope, edge cases and distributions that ride on the row-rule scan of their table."""
    count = F.count_if
    season = F.col("created_at") >= instant(SEASON_START)
    rows = F.count(F.lit(1))
    in_season = (rows > 0) & (count(season) * 100).between(rows * 74, rows * 76)
    extra = {
        "products": [Measure("edge_case", "products.inactive", count(~F.col("active")), SOME)],
        "orders": [
            Measure("edge_case", "orders.cancelled", count(F.col("status") == "CANCELLED"), SOME),
            Measure("distribution", "orders.season_ppm", _ppm(count(season), rows), "BETWEEN 740000 AND 760000", in_season),
        ],
        "shipments": [
            Measure(
                "edge_case", "shipments.delivered",
                count((F.col("status") == "DELIVERED") & F.col("delivered_at").isNotNull()), SOME,
            )
        ],
        "inventory_movements": [
            Measure("edge_case", "inventory_movements.positive", count(F.col("quantity_delta") > 0), SOME),
            Measure("edge_case", "inventory_movements.negative", count(F.col("quantity_delta") < 0), SOME),
        ],
    }
    envelope = {
        name: [
            Measure(
                "date_envelope", f"{name}.{c}",
                count((F.col(c) < instant(YEAR_2023)) | (F.col(c) >= instant(ENVELOPE_END))),
            )
            for c in timestamp_columns(df)
        ]
        for name, df in tables.items()
    }
    return {name: [*measures, *extra.get(name, [])] for name, measures in envelope.items()}


def customer_facts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per customer: orders, and the earliest order time. A hot customer arrives as one row."""
    per_customer = tables["orders"].groupBy(F.col("customer_id").alias("id")).agg(
        F.count(F.lit(1)).alias("orders"), F.min("created_at").alias("first_order_at")
    )
    return tables["customers"].join(per_customer, "id", "left")


def customer_checks(tables: dict[str, DataFrame], counts: dict[str, int]) -> DataFrame:
    orders = F.coalesce("orders", F.lit(0))
    favoured = F.sum(F.when(F.col("id") <= counts["customers"] // 10, orders).otherwise(0))
    high_volume = counts["orders"] // 20
    busiest = F.max(F.when(F.col("id") == HOT_CUSTOMER, orders))
    return measured(customer_facts(tables), [
        Measure("edge_case", "customers.without_orders", F.count_if(F.col("orders").isNull()), SOME),
        Measure("edge_case", "customers.busiest_orders", busiest, f">= {high_volume}"),
        Measure("chronology", "customers.ordered_before_created", F.count_if(F.col("first_order_at") < F.col("created_at"))),
        Measure("distribution", "orders.first_tenth_of_customers_ppm", _ppm(favoured, F.sum(orders)), "> 600000", favoured * 10 > F.sum(orders) * 6),
    ])


def product_facts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per product: sold lines, lowest and highest sale price, movements and net stock."""
    sold = tables["order_items"].groupBy(F.col("product_id").alias("id")).agg(
        F.count(F.lit(1)).alias("lines"), F.min("unit_price").alias("lowest"), F.max("unit_price").alias("highest")
    )
    moved = tables["inventory_movements"].groupBy(F.col("product_id").alias("id")).agg(
        F.count(F.lit(1)).alias("movements"), F.sum("quantity_delta").alias("net")
    )
    return tables["products"].join(sold, "id", "left").join(moved, "id", "left")


def product_checks(tables: dict[str, DataFrame], counts: dict[str, int]) -> DataFrame:
    lines = F.coalesce("lines", F.lit(0))
    favoured = F.sum(F.when(F.col("id") <= counts["products"] // 10, lines).otherwise(0))

    def net(product: int):
        return F.max(F.when(F.col("id") == product, F.col("net")))

    return measured(product_facts(tables), [
        Measure("edge_case", "products.without_items", F.count_if(F.col("lines").isNull()), SOME),
        Measure("edge_case", "products.sold_at_other_price", F.count_if((F.col("lowest") != F.col("price")) | (F.col("highest") != F.col("price"))), SOME),
        Measure("distribution", "order_items.first_tenth_of_products_ppm", _ppm(favoured, F.sum(lines)), "> 700000", favoured * 10 > F.sum(lines) * 7),
        Measure("edge_case", "products.many_movements", F.count_if(F.col("movements") >= BUSY_LEDGER), SOME),
        Measure("edge_case", "products.one_movement", F.count_if(F.col("movements") == 1), SOME),
        Measure("edge_case", "products.net_of_1", net(1), "= 0"),
        Measure("edge_case", "products.net_of_2", net(2), "= 1"),
        Measure("edge_case", "products.net_of_3", net(3), "= -1"),
    ])


def order_facts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per order with everything known about its children.

    Each child table is reduced to one row per order before it is joined, so every table is shuffled once,
    on the order id, and all joins share that partitioning.
    """
    items = tables["order_items"].groupBy(F.col("order_id").alias("id")).agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("total")
    )
    failed, succeeded = F.col("status") == "FAILED", F.col("status") == "SUCCEEDED"
    paid = tables["payments"].groupBy(F.col("order_id").alias("id")).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.bool_and(failed).alias("all_failed"),
        F.bool_or(F.col("status") == "REFUNDED").alias("refunded"),
        F.min("amount").alias("lowest_amount"),
        F.max("amount").alias("highest_amount"),
        F.min("created_at").alias("first_payment_at"),
        F.min(F.when(failed, F.col("created_at"))).alias("first_failure_at"),
        F.max(F.when(succeeded, F.col("created_at"))).alias("last_success_at"),
    )
    sent = tables["shipments"].groupBy(F.col("order_id").alias("id")).agg(
        F.count(F.lit(1)).alias("shipments"),
        F.bool_and(F.col("status") == "DELIVERED").alias("all_delivered"),
        F.bool_or(F.col("status") != "SHIPPED").alias("any_not_shipped"),
        F.min("shipped_at").alias("shipped_at"),
    )
    moment = F.struct("changed_at", "id")
    event = F.struct("status", "changed_at")
    history = (
        tables["order_status_history"]
        .groupBy("order_id", "changed_at")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.min_by(event, moment).alias("first"),
            F.max_by(event, moment).alias("last"),
            F.bool_or(F.col("status") == "PAID").alias("paid"),
        )
        .groupBy(F.col("order_id").alias("id"))
        .agg(
            F.sum(F.col("events") - 1).alias("tied_events"),
            F.min_by("first", "changed_at").alias("first"),
            F.max_by("last", "changed_at").alias("last"),
            F.bool_or("paid").alias("was_paid"),
        )
    )
    return (
        tables["orders"].join(items, "id", "left").join(paid, "id", "left").join(sent, "id", "left").join(history, "id", "left")
    )


def order_checks(tables: dict[str, DataFrame]) -> DataFrame:
    fulfilled = F.col("status").isin("SHIPPED", "COMPLETED")
    has_shipment = F.col("shipments").isNotNull()
    count = F.count_if

    def bad(condition):
        return count(F.coalesce(condition, F.lit(False)))

    inconsistent = (
        ~fulfilled.eqNullSafe(has_shipment)
        | F.coalesce(F.col("shipped_at") < F.col("created_at"), F.lit(False))
        | F.coalesce((F.col("status") == "COMPLETED") & ~F.col("all_delivered"), F.lit(False))
    )
    total = F.coalesce("total", F.lit(-1))
    return measured(order_facts(tables), [
        Measure("cross_table", "orders.without_items", count(F.col("total").isNull())),
        Measure("cross_table", "orders.without_payments", count(F.col("attempts").isNull())),
        Measure("edge_case", "orders.one_payment", count(F.col("attempts") == 1), SOME),
        Measure("edge_case", "orders.several_payments", count(F.col("attempts") > 1), SOME),
        Measure("edge_case", "orders.all_payments_failed", count(F.col("all_failed")), SOME),
        Measure("edge_case", "orders.success_after_failure", count(F.col("first_failure_at") < F.col("last_success_at")), SOME),
        Measure("edge_case", "orders.without_shipments", count(~has_shipment), SOME),
        Measure("cross_table", "payments.amount_and_order_total", bad((F.col("lowest_amount") != total) | (F.col("highest_amount") != total))),
        Measure("chronology", "payments.created_at_and_order", bad(F.col("first_payment_at") < F.col("created_at"))),
        Measure("cross_table", "shipments.row_and_order_status", count(inconsistent)),
        Measure("cross_table", "shipments.status_of_shipped_order", bad((F.col("status") == "SHIPPED") & F.col("any_not_shipped"))),
        Measure("cross_table", "order_status_history.last_status", count(~F.col("last.status").eqNullSafe(F.col("status")))),
        Measure("chronology", "order_status_history.equal_times", F.coalesce(F.sum("tied_events"), F.lit(0))),
        Measure("chronology", "order_status_history.before_order", bad(F.col("first.changed_at") < F.col("created_at"))),
        Measure("cross_table", "order_status_history.first_status", bad((F.col("first.status") != "PENDING") | (F.col("first.changed_at") != F.col("created_at")))),
        Measure("cross_table", "payments.refunded_and_paid", bad(F.col("refunded") & ~F.col("was_paid"))),
    ])


def tie_checks(tables: dict[str, DataFrame]) -> DataFrame:
    ties = tables["orders"].groupBy("customer_id", "created_at").agg(F.count(F.lit(1)).alias("orders")).where("orders > 1")
    return measured(ties, [Measure("edge_case", "orders.same_customer_and_time", F.count(F.lit(1)), SOME)])


def hierarchy_checks(tables: dict[str, DataFrame]) -> DataFrame:
    return measured(hierarchy.depths(tables["categories"]), [
        Measure("hierarchy", "categories.cycle", F.count_if("cyclic")),
        Measure("hierarchy", "categories.depth", F.max("depth"), f"= {TREE_DEPTH}"),
    ])


def verify(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    counts: dict[str, int],
    contract: Contract = COMMERCE,
    stored_catalog: DataFrame | None = None,
) -> DataFrame:
    """The whole contract in one report. ``counts`` are the expected rows per table."""
    return union_all([
        structural(spark, contract, tables, counts, stored_catalog, single_table_measures(tables)),
        customer_checks(tables, counts),
        product_checks(tables, counts),
        order_checks(tables),
        tie_checks(tables),
        hierarchy_checks(tables),
    ])
