"""The usual commerce questions, with the columns named by the caller."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.operators import ordered


def order_totals(items: DataFrame, order: str, line_amount: Column, total: str = "total") -> DataFrame:
    """Order total from the historical line prices."""
    return items.groupBy(order).agg(F.sum(line_amount).cast("decimal(18,2)").alias(total))


def total_mismatches(
    claims: DataFrame, order: str, claimed: str, items: DataFrame, item_order: str, line_amount: Column
) -> DataFrame:
    """Rows whose claimed amount is not the sum of the order's lines; an order without lines sums to NULL."""
    totals = order_totals(items, item_order, line_amount, "line_total").withColumnRenamed(item_order, order)
    return claims.join(totals, order, "left").where(~F.col(claimed).eqNullSafe(F.col("line_total")))


def receipts(payments: DataFrame, status: str, amount: str, by: list[str] = ()) -> DataFrame:
    """Gross, refunded and net receipts. Failed and pending attempts are no receipts, and a refunded
    attempt is a returned receipt, so attempts are never simply summed."""

    def total(*statuses: str) -> Column:
        chosen = F.when(F.col(status).isin(*statuses), F.col(amount)).otherwise(F.lit(0).cast("decimal(12,2)"))
        return F.sum(chosen).cast("decimal(20,2)")

    return payments.groupBy(*by).agg(
        total("SUCCEEDED", "REFUNDED").alias("gross"), total("REFUNDED").alias("refunded"), total("SUCCEEDED").alias("net")
    )


def attempt_profile(attempts: DataFrame, by: list[str], failed: Column, succeeded: Column, moment: str) -> DataFrame:
    """One row per group: attempts, whether all failed, and whether a success followed a failure.

    ``min(failure time) < max(success time)`` is equivalent to some failure preceding some success, and
    needs no pairing of attempts.
    """
    return attempts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.bool_and(failed).alias("failed_only"),
        F.coalesce(
            F.min(F.when(failed, F.col(moment))) < F.max(F.when(succeeded, F.col(moment))), F.lit(False)
        ).alias("success_after_failure"),
    )


def attempt_sequence(attempts: DataFrame, by: list[str], order: list[str], task_rows: int = ordered.SCAN_ROWS) -> DataFrame:
    """Attempts numbered in time order inside their group."""
    return ordered.scan(attempts, by, order, number="attempt", task_rows=task_rows)


def running_balance(
    ledger: DataFrame, product: str, order: list[str], delta: str, task_rows: int = ordered.SCAN_ROWS
) -> DataFrame:
    """Ledger rows with the balance after each movement; no opening balance, may be negative."""
    return ordered.scan(ledger, [product], order, sums={"balance": delta}, task_rows=task_rows)


def child_sales(products: DataFrame, product: str, items: DataFrame, item_product: str, quantity: Column, amount: Column) -> DataFrame:
    """Every product with its sales; products never sold show 0."""
    sold = items.groupBy(F.col(item_product).alias(product)).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(quantity).alias("units"), F.sum(amount).alias("revenue")
    )
    zero = lambda name, kind: F.coalesce(F.col(name), F.lit(0)).cast(kind).alias(name)
    return products.join(sold, product, "left").select(
        *products.columns, zero("lines", "bigint"), zero("units", "bigint"), zero("revenue", "decimal(18,2)")
    )


def after_cursor(columns: list[str], cursor: list[Column]) -> Column:
    """Row-value comparison (columns) > (cursor), led by a plain bound that reaches the file scan."""
    branches = []
    for i, (name, value) in enumerate(zip(columns, cursor)):
        equal = [F.col(columns[j]) == cursor[j] for j in range(i)]
        branches.append(reduce(lambda a, b: a & b, [*equal, F.col(name) > value]))
    return (F.col(columns[0]) >= cursor[0]) & reduce(lambda a, b: a | b, branches)


def keyset_page(df: DataFrame, order: list[str], size: int, cursor: list[Column] | None = None) -> DataFrame:
    """The next ``size`` rows after a cursor in a unique order; each task keeps only ``size`` rows."""
    rows = df.where(after_cursor(order, cursor)) if cursor else df
    return rows.orderBy(*order).limit(size)


def status_mismatches(parents: DataFrame, key: str, status: str, latest: DataFrame, latest_status: str) -> DataFrame:
    """Parents whose status is not that of their last event, or that have no event at all."""
    return parents.join(latest, key, "left").where(~F.col(status).eqNullSafe(F.col(latest_status)))


def unordered_events(
    events: DataFrame, by: list[str], moment: str, ident: str, task_rows: int = ordered.SCAN_ROWS
) -> DataFrame:
    """Events whose predecessor in (moment, id) order is not strictly earlier."""
    scanned = ordered.scan(
        events.select(*by, moment, ident), by, [moment, ident], previous={"previous__": moment}, task_rows=task_rows
    )
    return scanned.where(F.col("previous__") >= F.col(moment)).drop("previous__")
