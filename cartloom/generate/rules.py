"""Per-order rules as plain data.

Everything that decides how many child rows an order has depends only on ``order id % 100``. One
100-order period therefore fixes the dense ids of all children in closed form, and no global
``row_number`` is needed.
"""

from __future__ import annotations

PERIOD = 100

# Order status by id % 100 (upper bounds are exclusive).
STATUS_CUTOFFS = [(5, "PENDING"), (10, "CANCELLED"), (25, "PAID"), (40, "SHIPPED")]
STATUS_REST = "COMPLETED"
REFUNDED_RESIDUES = (8, 9)
RETRY_EVERY = 5

# Minutes after order creation.
RETRY_MINUTE = 6
PAID_MINUTE = 15
CANCELLED_MINUTE = 60
SHIPPED_MINUTE = 1440
COMPLETED_MINUTE = 4320
ATTEMPT_MINUTES = 5

# Choices by a draw below ten, as (exclusive upper bound, ...).
PROVIDER_BANDS = [(7, "stripe"), (9, "adyen"), (10, "paypal")]
CATEGORY_BANDS = [(6, 33, 4), (10, 17, 24)]  # first category, number of categories
CUSTOMER_BANDS = [(6, 1), (10, 9)]  # tenths of the customers
PRODUCT_BANDS = [(7, 10), (10, 95)]  # hundredths of the products

# Prices in cents, discounts in percent, and every how many orders the hot customer orders.
PRICE_STEPS = 10_000
PRICE_DIVISOR = 1_000
LOWEST_CENTS = 500
LOWEST_PERCENT = 80
PERCENTS = 31
HOT_ORDER_EVERY = 20


def status_of(order: int) -> str:
    residue = order % PERIOD
    for bound, status in STATUS_CUTOFFS:
        if residue < bound:
            return status
    return STATUS_REST


def items_of(order: int) -> int:
    return 1 + order % 5


def attempts_of(order: int) -> int:
    return 2 if order % RETRY_EVERY == 0 else 1


def outcomes_of(order: int) -> list[str]:
    """Payment statuses of an order, attempt by attempt."""
    cancelled = "REFUNDED" if order % PERIOD in REFUNDED_RESIDUES else "FAILED"
    last = {"PENDING": "PENDING", "CANCELLED": cancelled}.get(status_of(order), "SUCCEEDED")
    return ["FAILED"] * (attempts_of(order) - 1) + [last]


def shipments_of(order: int) -> int:
    return int(status_of(order) in ("SHIPPED", "COMPLETED"))


def events_of(order: int) -> list[tuple[str, int]]:
    """(status, minute) events of an order in time order."""
    status = status_of(order)
    fulfilled = status in ("PAID", "SHIPPED", "COMPLETED")
    events = [("PENDING", 0)]
    if order % RETRY_EVERY == 0:
        events.append(("PENDING", RETRY_MINUTE))
    if fulfilled or order % PERIOD in REFUNDED_RESIDUES:
        events.append(("PAID", PAID_MINUTE))
    if status == "CANCELLED":
        events.append(("CANCELLED", CANCELLED_MINUTE))
    if status in ("SHIPPED", "COMPLETED"):
        events.append(("SHIPPED", SHIPPED_MINUTE))
    if status == "COMPLETED":
        events.append(("COMPLETED", COMPLETED_MINUTE))
    return events


def rows_before(per_order) -> list[int]:
    """Child rows of the orders before position r (0-based) of a period, for each r."""
    counts, before = 0, []
    for order in range(1, PERIOD + 1):
        before.append(counts)
        counts += per_order(order)
    return before


def rows_per_period(per_order) -> int:
    return sum(per_order(order) for order in range(1, PERIOD + 1))
