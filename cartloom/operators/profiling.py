"""Reports about tables: one scan per table, unpivoted into rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unpivot(row: DataFrame, entries: list[dict[str, str]]) -> DataFrame:
    """Turn a one-row aggregate into one row per entry; entries map column names to SQL expressions."""
    structs = [
        "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in entry.items()) + ")" for entry in entries
    ]
    return row.selectExpr(f"inline(array({', '.join(structs)}))")


def text(value: str) -> str:
    """SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def timestamp_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]


def date_ranges(tables: dict[str, DataFrame]) -> DataFrame:
    """(column_name, first_at, last_at) of every timestamp column of every table."""
    frames = []
    for name, df in sorted(tables.items()):
        columns = timestamp_columns(df)
        if not columns:
            continue
        row = df.agg(*[a for c in columns for a in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))])
        frames.append(unpivot(row, [
            {"column_name": text(f"{name}.{c}"), "first_at": f"lo_{c}", "last_at": f"hi_{c}"} for c in columns
        ]))
    return union_all(frames)


def outside_envelope(tables: dict[str, DataFrame], first: Column, end: Column) -> DataFrame:
    """(column_name, violations): values outside the half-open range; NULL is ignored."""
    frames = []
    for name, df in sorted(tables.items()):
        columns = timestamp_columns(df)
        if not columns:
            continue
        row = df.agg(*[F.count_if((F.col(quoted(c)) < first) | (F.col(quoted(c)) >= end)).alias(c) for c in columns])
        frames.append(unpivot(row, [{"column_name": text(f"{name}.{c}"), "violations": quoted(c)} for c in columns]))
    return union_all(frames)


def quoted(name: str) -> str:
    """A column name as SQL reads it, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in sorted(tables.items())
    ])


def null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(column_name, nulls) of every column of every table."""
    frames = []
    for name, df in sorted(tables.items()):
        row = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in df.columns])
        frames.append(unpivot(row, [{"column_name": text(f"{name}.{c}"), "nulls": quoted(c)} for c in df.columns]))
    return union_all(frames)


def frequencies(df: DataFrame, column: str, count: str = "row_count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count))


def facts(named: dict[str, DataFrame]) -> DataFrame:
    """(fact, value): one named count per relation."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("fact"), "value")
        for name, df in named.items()
    ])
