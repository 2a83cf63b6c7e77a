"""Registered queries: a Spark plan over the given tables, and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


class Registry(dict):
    """Name to query; modules add to it with a decorator."""

    def add(self, name: str, sql: str | None) -> Callable[[Run], Run]:
        def register(run: Run) -> Run:
            if name in self:
                raise ValueError(f"query {name} is registered twice")
            self[name] = Query(run, sql)
            return run

        return register


def all_queries() -> Registry:
    from cartloom.plans import answers, changes, checks, digests, generation, trees

    merged = Registry()
    for module in (generation, checks, answers, trees, digests, changes):
        merged.update(module.QUERIES)
    return merged
