"""Size profiles of the generated tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

DEFAULT_NAMESPACE = "cartloom-v1:42:"

# Fixed values of the published profiles.
EMAIL_DIGITS = 6
PRODUCT_DIGITS = 5
LEDGER_STEPS = 10_000
CATEGORIES = 40


@dataclass(frozen=True)
class Profile:
    """Sizes, and the widths of draws and labels. ``times`` changes sizes only, so a row of an id that doesn't depend on
    the number of rows stays as it was; ``wide`` asks for draws that reach every key of a very large profile."""

    name: str
    customers: int
    products: int
    orders: int
    movements: int
    namespace: str = DEFAULT_NAMESPACE
    hash_digits: int = 8  # draws lie below 16 ** hash_digits
    email_digits: int = EMAIL_DIGITS  # least width; a longer id is written whole
    product_digits: int = PRODUCT_DIGITS
    ledger_steps: int = LEDGER_STEPS  # distinct inputs of the quadratic ledger draw

    def __post_init__(self):
        if self.customers < 0 or self.products < 0 or self.orders < 0 or self.movements < 0:
            raise ValueError(f"profile {self.name!r} has a negative size")

    def require_size(self) -> None:
        """The documented least sizes with which the skew and fixture rules can hold."""
        if self.customers < 20 or self.products < 20 or self.orders < 2 or self.movements < 7:
            raise ValueError(f"profile {self.name!r} is too small for the skew and fixture rules")

    def with_namespace(self, namespace: str) -> Profile:
        return replace(self, namespace=namespace)

    def times(self, factor: int) -> Profile:
        """The same shape and widths at ``factor`` times the rows."""
        return replace(
            self,
            name=f"{self.name}x{factor}",
            customers=self.customers * factor,
            products=self.products * factor,
            orders=self.orders * factor,
            movements=self.movements * factor,
        )

    def wide(self) -> Profile:
        """Draws of 60 bits and a ledger that can move every product; other rows than without."""
        return replace(self, hash_digits=15, ledger_steps=10**12)

    def expected_counts(self) -> dict[str, int]:
        """Exact row counts, derived from the fan-out rules of one 100-order period."""
        from cartloom.generate import rules

        full, rest = divmod(self.orders, rules.PERIOD)
        tail = range(1, rest + 1)

        def total(per_order):
            whole = sum(per_order(o) for o in range(1, rules.PERIOD + 1))
            return full * whole + sum(per_order(o) for o in tail)

        return {
            "customers": self.customers,
            "categories": CATEGORIES,
            "products": self.products,
            "orders": self.orders,
            "order_items": total(rules.items_of),
            "payments": total(rules.attempts_of),
            "shipments": total(rules.shipments_of),
            "order_status_history": total(lambda o: len(rules.events_of(o))),
            "inventory_movements": self.movements,
        }


# Fixed sizes of the two published profiles.
PROFILES = {
    "small": Profile("small", customers=2_000, products=500, orders=15_000, movements=40_000),
    "full": Profile("full", customers=50_000, products=10_000, orders=300_000, movements=600_000),
}


def profile_named(name: str, namespace: str = DEFAULT_NAMESPACE) -> Profile:
    if name not in PROFILES:
        raise ValueError(f"unknown profile {name!r}; known: {', '.join(PROFILES)}")
    return PROFILES[name].with_namespace(namespace)
