"""Canonical text and digests of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed format: one line of JSON, columns in declared order, nulls kept, decimals unquoted with their scale,
# timestamps as 2024-01-31T23:59:59.5+00:00 with the fraction only where there is one.
JSON_OPTIONS = {"ignoreNullFields": "false", "timeZone": "UTC"}

NULL_MARK = "\\N"


def utc_ntz(moment: Column) -> Column:
    """UTC wall-clock reading of a timestamp, independent of the session time zone."""
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.expr("interval '0.000001' second") * F.unix_micros(moment)


def iso_text(df: DataFrame, column: str) -> Column:
    """A timestamp column as ISO text with a +00:00 offset; other columns unchanged."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        moment = utc_ntz(F.col(column))
    elif isinstance(kind, T.TimestampNTZType):
        moment = F.col(column)
    else:
        return F.col(column)
    return F.concat(F.translate(moment.cast("string"), " ", "T"), F.lit("+00:00")).alias(column)


def row_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Row as canonical JSON text."""
    return F.to_json(F.struct(*[iso_text(df, c) for c in columns or df.columns]), JSON_OPTIONS)


def row_text(columns: list[str]) -> Column:
    """Row as '|'-separated text with a NULL marker, for engines without the same JSON printer."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns])


def hex_number(digest: Column, first: int, count: int) -> Column:
    """``count`` (at most 15) hex digits of ``digest`` as a bigint."""
    return F.conv(F.substring(digest, first, count), 16, 10).cast("bigint")
