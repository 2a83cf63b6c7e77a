"""A relational contract as plain data: columns, keys, references and row rules."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    nullable: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class Check:
    """A row rule in SQL. A row breaks it only when it is FALSE; NULL passes."""

    name: str
    expression: str

    @staticmethod
    def nonempty(column: str) -> Check:
        return Check(f"{column}.nonempty", f"trim({column}) <> ''")

    @staticmethod
    def finite_amount(column: str) -> Check:
        # NaN sorts above infinity, so the upper bound also rejects NaN in double columns.
        return Check(f"{column}.finite_amount", f"{column} >= 0 AND CAST({column} AS DOUBLE) < CAST('Infinity' AS DOUBLE)")

    @staticmethod
    def one_of(column: str, values: list[str]) -> Check:
        listed = ", ".join(f"'{v}'" for v in values)
        return Check(f"{column}.one_of", f"{column} IN ({listed})")

    @staticmethod
    def compare(column: str, condition: str, name: str) -> Check:
        return Check(f"{column}.{name}", f"{column} {condition}")


@dataclass(frozen=True)
class Reference:
    column: str
    table: str
    key: str = "id"


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ("id",)
    uniques: tuple[tuple[str, ...], ...] = ()
    references: tuple[Reference, ...] = ()
    checks: tuple[Check, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(c.name, T._parse_datatype_string(c.type), c.nullable) for c in self.columns
        ])

    def row_rules(self) -> list[tuple[str, str, str]]:
        """(rule class, rule name, SQL condition that holds for a good row)."""
        required = {*self.primary_key, *(c.name for c in self.columns if not c.nullable)}
        rules = [("not_null", c.name, f"{c.name} IS NOT NULL") for c in self.columns if c.name in required]
        rules += [
            ("length", f"{c.name}.length", f"char_length({c.name}) <= {c.max_length}")
            for c in self.columns
            if c.max_length
        ]
        return rules + [("check", c.name, c.expression) for c in self.checks]


@dataclass(frozen=True)
class Contract:
    tables: tuple[Table, ...]

    def __getitem__(self, name: str) -> Table:
        for table in self.tables:
            if table.name == name:
                return table
        raise KeyError(name)

    @property
    def names(self) -> list[str]:
        return [t.name for t in self.tables]

    def without_reference(self, table: str, column: str) -> Contract:
        """The contract with one reference dropped."""
        return Contract(tuple(
            replace(t, references=tuple(r for r in t.references if r.column != column)) if t.name == table else t
            for t in self.tables
        ))

    def referencing(self, parent: str) -> list[tuple[Table, Reference]]:
        return [(t, r) for t in self.tables for r in t.references if r.table == parent]

    def entries(self) -> list[tuple[str, str, str]]:
        """(kind, name, definition) of every rule, sorted; the inventory that is diffed with a stored copy."""
        rows = []
        for t in self.tables:
            rows += [
                ("column", f"{t.name}.{c.name}", f"{i} {c.type}{f'({c.max_length})' if c.max_length else ''}"
                 f"{'' if c.nullable else ' NOT NULL'}")
                for i, c in enumerate(t.columns, start=1)
            ]
            rows.append(("primary_key", f"{t.name}.{'_'.join(t.primary_key)}", f"({', '.join(t.primary_key)})"))
            rows += [("unique", f"{t.name}.{'_'.join(u)}", f"({', '.join(u)})") for u in t.uniques]
            rows += [("foreign_key", f"{t.name}.{r.column}", f"{r.table}({r.key})") for r in t.references]
            rows += [("check", f"{t.name}.{c.name}", c.expression) for c in t.checks]
        return sorted(rows)

    def catalog(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.entries(), "kind string, name string, definition string")


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Declared columns in declared order, cast to the declared types."""
    return df.select(*[F.col(c.name).cast(c.type).alias(c.name) for c in table.columns])
