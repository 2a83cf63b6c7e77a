"""Stateless pseudo-random draws as Column expressions.

Every draw is a pure function of (namespace, stream, key), so a row can be generated in any task, in
any order, and again after an executor is lost, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_hash(key: Column, stream: str, namespace: str, hex_digits: int = 8) -> Column:
    """Unsigned integer from the leading hex digits of md5(namespace || stream || ':' || key).

    NULL in, NULL out. Eight digits give [0, 2^32); fifteen still fit a signed bigint.
    """
    digest = F.md5(F.concat(F.lit(f"{namespace}{stream}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")


def quotient(left: Column, right: Column | int) -> Column:
    """Truncating integer division (``/`` would give a double)."""
    return F.call_function("div", left, right if isinstance(right, Column) else F.lit(right).cast("bigint"))


def weighted(draw: Column, cutoffs: list[tuple[int, object]], otherwise: object) -> Column:
    """Categorical value: the first label whose cutoff lies above ``draw``."""
    chosen = None
    for cutoff, label in cutoffs:
        condition = draw < cutoff
        value = label if isinstance(label, Column) else F.lit(label)
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return chosen.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def pick(values: list[str], zero_based: Column) -> Column:
    """Element of a short literal list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (zero_based + 1).cast("int"))


def padded(number: Column, width: int) -> Column:
    """Decimal label with zeros in front up to ``width``; longer numbers are written whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def instant(epoch_seconds: int, offset_seconds: Column | int = 0) -> Column:
    """Timestamp ``offset_seconds`` after a fixed UTC instant, whatever the session time zone."""
    return F.timestamp_seconds(F.lit(epoch_seconds).cast("bigint") + offset_seconds)


def later(moment: Column, seconds: Column | int) -> Column:
    """``moment`` shifted by exact seconds; adding an interval would follow the session's clock changes."""
    return F.timestamp_micros(F.unix_micros(moment) + seconds * F.lit(1_000_000).cast("bigint"))
