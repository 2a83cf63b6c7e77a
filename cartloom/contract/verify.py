"""Checks as rows: (check, subject, expected, observed, passed).

All single-table rules of a table are evaluated in one aggregate over one scan. A check whose condition is
NULL fails.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass, replace

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.contract.model import Contract, Table
from cartloom.operators import keys
from cartloom.operators.profiling import quoted, text, union_all, unpivot

REPORT_SCHEMA = "check string, subject string, expected string, observed bigint, passed boolean"
NONE, SOME = "= 0", ">= 1"


class VerificationError(AssertionError):
    """Raised on the driver when a report holds failed checks."""


@dataclass(frozen=True)
class Measure:
    """One aggregate over a relation, and the condition its value must meet, such as ``= 0`` or ``>= 1``.

    ``holds`` replaces the condition by an aggregate of its own, where the reported value is rounded.
    """

    check: str
    subject: str
    aggregate: Expr
    expected: str = NONE
    holds: Expr | None = None


def measured(df: DataFrame, measures: list[Measure]) -> DataFrame:
    """Evaluate all measures in one aggregate and return one report row each."""
    row = df.agg(
        *[m.aggregate.cast("bigint").alias(f"m{i}") for i, m in enumerate(measures)],
        *[m.holds.alias(f"h{i}") for i, m in enumerate(measures) if m.holds is not None],
    )
    return unpivot(row, [
        {
            "check": text(m.check),
            "subject": text(m.subject),
            "expected": text(m.expected),
            "observed": f"m{i}",
            "passed": f"coalesce({f'h{i}' if m.holds is not None else f'm{i} {m.expected}'}, false)",
        }
        for i, m in enumerate(measures)
    ])


_CONDITIONS = {"=": operator.eq, ">=": operator.ge, "<=": operator.le, ">": operator.gt, "<": operator.lt}


class Observer:
    """Measures of tables taken by the job that writes them, so that nothing is read again for them.

    ``watch`` goes on the rows as they are written, behind every shuffle: the tasks of a job's last stage count once, however
    often they run. Rows are counted beside the measures; where that count is not the one of the files, the table is measured
    by a scan of these instead.
    """

    def __init__(self, measures: dict[str, list[Measure]]):
        self.measures = {name: own for name, own in measures.items() if own}
        self.taken: dict[str, Observation] = {}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        own = self.measures.get(name)
        if not own:
            return df
        self.taken[name] = Observation()
        return df.observe(
            self.taken[name], F.count(F.lit(1)).alias("rows"),
            *[m.aggregate.cast("bigint").alias(f"m{i}") for i, m in enumerate(own)],
            *[m.holds.alias(f"h{i}") for i, m in enumerate(own) if m.holds is not None],
        )

    def report(self, spark: SparkSession, written: dict[str, DataFrame], row_counts: dict[str, int]) -> DataFrame:
        """Report rows of all tables that were watched and ``written``; ``row_counts`` are those of the files."""
        rows, frames = [], []
        for name, own in self.measures.items():
            values = self.taken[name].get
            if values["rows"] != row_counts[name]:
                frames.append(measured(written[name], own))
                continue
            for i, m in enumerate(own):
                sign, number = m.expected.split(" ")
                value = values[f"m{i}"]
                holds = values[f"h{i}"] if m.holds is not None else value is not None and _CONDITIONS[sign](value, int(number))
                rows.append((m.check, m.subject, m.expected, value, bool(holds)))
        return union_all([spark.createDataFrame(rows, REPORT_SCHEMA), *frames])


def violations(rule: str) -> Expr:
    """Rows for which an SQL condition is FALSE; NULL passes."""
    return F.expr(f"count_if(NOT ({rule}))")


def row_measures(table: Table, rule_classes: tuple[str, ...] = ("not_null", "length", "check")) -> list[Measure]:
    return [
        Measure(kind, f"{table.name}.{name}", violations(rule))
        for kind, name, rule in table.row_rules()
        if kind in rule_classes
    ]


def scan_rules(
    contract: Contract,
    tables: dict[str, DataFrame],
    rule_classes: tuple[str, ...] = ("not_null", "length", "check"),
    expected_counts: dict[str, int] | None = None,
    extra: dict[str, list[Measure]] | None = None,
) -> DataFrame:
    """Row rules, row counts and any further measures; one scan per table for all of them."""
    frames = []
    for table in contract.tables:
        measures = row_measures(table, rule_classes)
        if table.name in (expected_counts or {}):
            measures.append(Measure("row_count", table.name, F.count(F.lit(1)), f"= {expected_counts[table.name]}"))
        measures += (extra or {}).get(table.name, [])
        if measures:
            frames.append(measured(tables[table.name], measures))
    return union_all(frames)


def key_rules(contract: Contract, tables: dict[str, DataFrame]) -> DataFrame:
    """Surplus rows per primary and unique key, and child rows per reference whose key has no parent.

    References are checked per parent: one grouping of the parent's key and all columns that refer to it
    answers them together, and the parent's own primary key with them.
    """
    frames = []
    for parent in contract.tables:
        pending = [("primary_key", parent.primary_key), *(("unique", u) for u in parent.uniques)]
        for key in sorted({r.key for _, r in contract.referencing(parent.name)}):
            references = [(t, r) for t, r in contract.referencing(parent.name) if r.key == key]
            profile = keys.reference_profile(tables[parent.name], key, [(tables[t.name], r.column) for t, r in references])
            measures = [
                Measure("foreign_key", f"{t.name}.{r.column}", _total(F.when(F.col("in_parent") == 0, F.col(f"in_child_{i}"))))
                for i, (t, r) in enumerate(references)
            ]
            if parent.primary_key == (key,):
                measures.append(Measure("primary_key", f"{parent.name}.{key}", _total(F.greatest(F.col("in_parent") - 1, F.lit(0)))))
                pending = pending[1:]
            frames.append(measured(profile, measures))
        for kind, columns in pending:
            surplus = Measure(kind, f"{parent.name}.{'_'.join(columns)}", _total(F.col("copies") - 1))
            frames.append(measured(keys.duplicates(tables[parent.name], list(columns)), [surplus]))
    return union_all(frames)


def _total(value: Expr) -> Expr:
    return F.coalesce(F.sum(value), F.lit(0))


def schema_report(spark: SparkSession, contract: Contract, tables: dict[str, DataFrame]) -> DataFrame:
    """Table set, and column order and types, compared on the driver (metadata only)."""
    rows = []
    for name in sorted({*contract.names, *tables}):
        known = name in contract.names and name in tables
        rows.append(("table_set", name, NONE, 0 if known else 1, known))
        if not known:
            continue
        declared = [(f.name, f.dataType) for f in contract[name].schema.fields]
        actual = [(f.name, f.dataType) for f in tables[name].schema.fields]
        for i in range(max(len(declared), len(actual))):
            want = declared[i] if i < len(declared) else None
            have = actual[i] if i < len(actual) else None
            column = (want or have)[0]
            rows.append(("column", f"{name}.{column}", NONE, int(want != have), want == have))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def column_report(contract: Contract, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, position, declared_type, actual_type, nulls, passed) of every declared column.

    Files report every column as nullable, so NOT NULL is measured on the rows; one scan per table.
    """
    frames = []
    for table in contract.tables:
        df = tables[table.name]
        actual = {f.name: (i, f.dataType) for i, f in enumerate(df.schema.fields, start=1)}
        required = {*table.primary_key, *(c.name for c in table.columns if not c.nullable)}
        present = [c.name for c in table.columns if c.name in actual]
        row = df.agg(F.count(F.lit(1)).alias("rows__"), *[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in present])
        entries = []
        for i, (declared, field) in enumerate(zip(table.columns, table.schema.fields), start=1):
            position, kind = actual.get(declared.name, (0, None))
            nulls = quoted(declared.name) if kind else "rows__"
            matches = position == i and kind == field.dataType
            entries.append({
                "table_name": text(table.name),
                "column_name": text(declared.name),
                "position": str(i),
                "declared_type": text(field.dataType.simpleString()),
                "actual_type": text(kind.simpleString()) if kind else "CAST(NULL AS STRING)",
                "nulls": nulls,
                "passed": f"{nulls} = 0" if matches and declared.name in required else str(matches).lower(),
            })
        frames.append(unpivot(row, entries))
    return union_all(frames)


def catalog_report(contract: Contract, stored: DataFrame) -> DataFrame:
    """The rule inventory must equal a stored copy, in both directions."""
    from cartloom.operators.diff import relation_diff

    drift = relation_diff(stored, contract.catalog(stored.sparkSession), "stored", "contract")
    return measured(drift, [Measure("rule_inventory", "contract", F.count(F.lit(1)))])


def found_inventory(contract: Contract, tables: dict[str, DataFrame]) -> DataFrame:
    """(kind, name, definition) of the rules that the tables bear out, in the form of the contract's inventory.

    Columns are described as they are: place, type, longest text, and NOT NULL where no row is null, undeclared columns too.
    Keys, references and checks of the contract are found if no row breaks them. One scan per table for the columns.
    """
    frames = []
    for table in contract.tables:
        df = tables[table.name]
        measures, entries = [], []
        for i, f in enumerate(df.schema.fields):
            is_text = isinstance(f.dataType, T.StringType)
            measures.append(F.count_if(F.col(quoted(f.name)).isNull()).alias(f"nulls_{i}"))
            measures.append((F.max(F.char_length(quoted(f.name))) if is_text else F.lit(None).cast("int")).alias(f"longest_{i}"))
            kind = text(f"{i + 1} {f.dataType.simpleString()}")
            entries.append({
                "kind": text("column"),
                "name": text(f"{table.name}.{f.name}"),
                "definition": f"concat({kind}, coalesce(concat('(', longest_{i}, ')'), ''), if(nulls_{i} = 0, ' NOT NULL', ''))",
            })
        frames.append(unpivot(df.agg(*measures), entries))
    spark = next(iter(tables.values())).sparkSession
    report = union_all([scan_rules(contract, tables, ("check",)), key_rules(contract, tables)])
    passed = report.where("passed").select(F.col("check").alias("kind"), F.col("subject").alias("name"))
    return union_all([*frames, contract.catalog(spark).join(F.broadcast(passed), ["kind", "name"], "left_semi")])


def structural(
    spark: SparkSession,
    contract: Contract,
    tables: dict[str, DataFrame],
    expected_counts: dict[str, int] | None = None,
    stored_catalog: DataFrame | None = None,
    extra: dict[str, list[Measure]] | None = None,
) -> DataFrame:
    """Schema, row rules, keys, references, and optionally counts, the rule inventory and extra measures.

    Rules about a missing table are left out; the missing table itself is reported.
    """
    present = Contract(tuple(
        replace(t, references=tuple(r for r in t.references if r.table in tables)) for t in contract.tables if t.name in tables
    ))
    parts = [
        schema_report(spark, contract, tables),
        scan_rules(present, tables, expected_counts=expected_counts, extra=extra),
        key_rules(present, tables),
    ]
    if stored_catalog is not None:
        parts.append(catalog_report(contract, stored_catalog))
    return union_all(parts)


def require(report: DataFrame) -> None:
    """Raise with the names of all failed checks; passes silently otherwise."""
    failed = report.where("NOT coalesce(passed, false)").orderBy("check", "subject").collect()
    if failed:
        lines = [f"{r['check']} {r.subject}: observed {r.observed}, expected {r.expected}" for r in failed]
        raise VerificationError(f"{len(failed)} checks failed\n" + "\n".join(lines))
