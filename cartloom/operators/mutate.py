"""Inserts, updates and deletes over immutable tables, with a quarantine for rule-breaking rows.

Every change is judged against the current tables, as if it were the only one, and against the other
changes of its set. A change that breaks a rule is left out of the new version and reported once per rule
with its class: unique, not_null, length, check or foreign_key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.contract.model import Contract, Table, conform
from cartloom.operators import closure, keys
from cartloom.operators.profiling import union_all
from cartloom.operators.skew import BROADCAST_ROWS, TASK_ROWS, fits_broadcast, lookup
from cartloom.session import cut_lineage

INSERT, UPDATE = "insert", "update"
ROWS_PER_DEAL = 250_000


class _Hint:
    """Broadcasts keys of a change set, but only if the whole set was measured and is small.

    Every hinted relation is a projection of the change set, so its size bounds them all. The keys of a large set are dealt like
    the buckets of the table that they meet, where it is bucketed by them, so that only the keys move. Where it is not, a set of
    more than ``TASK_ROWS`` rows is dealt to tasks of ``ROWS_PER_DEAL`` rows, and the table that it meets alike.
    """

    def __init__(self, changes: DataFrame, buckets: dict[str, int] | None = None, broadcast_rows: int = BROADCAST_ROWS):
        self.small = fits_broadcast(changes, broadcast_rows)
        self.buckets = buckets or {}
        self.rows = 0 if self.small else changes.count()

    def __call__(self, subset: DataFrame, meets: str | None = None) -> DataFrame:
        if self.small:
            return F.broadcast(subset)
        return subset.repartition(self.buckets[meets], *subset.columns) if meets in self.buckets else subset

    def dealt(self, changes: DataFrame, table: Table) -> DataFrame:
        """The rows of a large set by their primary key, for all joins and groupings by it; a smaller set is left to Spark."""
        tasks = self.buckets.get(table.name)
        if tasks is None and self.rows > TASK_ROWS:
            tasks = max(int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-self.rows // ROWS_PER_DEAL))
        return changes if self.small or tasks is None else changes.repartition(tasks, *table.primary_key)


@dataclass(frozen=True)
class Outcome:
    table: DataFrame
    rejected: DataFrame


def update_where(df: DataFrame, condition: Expr, assignments: dict[str, Expr]) -> DataFrame:
    """UPDATE ... SET ... WHERE: rows for which the condition is TRUE take the new values."""
    return df.select(*[
        F.when(condition, assignments[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
        if c in assignments
        else F.col(c)
        for c in df.columns
    ])


def update_from(df: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """UPDATE ... FROM: rows with a partner in ``source`` (unique ``key``) take its values, NULLs included."""
    fresh = source.select(key, F.struct(*columns).alias("fresh__"))
    # The source may be an aggregate, so it is not counted just to decide on a broadcast.
    joined = lookup(df, fresh, key, "left", broadcast_rows=0)
    return joined.select(*[
        F.when(F.col("fresh__").isNotNull(), F.col(f"fresh__.{c}")).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
        if c in columns
        else F.col(c)
        for c in df.columns
    ])


def delete_where(df: DataFrame, condition: Expr) -> DataFrame:
    """DELETE ... WHERE: drops rows for which the condition is TRUE; NULL keeps the row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def _row_breaches(changes: DataFrame, table: Table) -> DataFrame:
    """Not-null, length and check breaches, all from one pass over the changes."""
    breaches = [
        F.when(~F.expr(rule), F.struct(F.lit(kind).alias("violation"), F.lit(name).alias("rule")))
        for kind, name, rule in table.row_rules()
    ]
    found = F.array_compact(F.array(*breaches))
    return changes.select(*table.primary_key, F.explode(found).alias("b")).select(*table.primary_key, "b.*")


def _label(df: DataFrame, key: tuple[str, ...], violation: str, rule: str) -> DataFrame:
    return df.select(*key, F.lit(violation).alias("violation"), F.lit(rule).alias("rule"))


def _key_breaches(changes: DataFrame, current: DataFrame, table: Table, hint: _Hint) -> list[DataFrame]:
    """Inserted keys that exist, updated keys that do not, and keys that occur twice in the set."""
    key = list(table.primary_key)
    rule = "_".join(key)
    changes = hint.dealt(changes, table)
    # One row per key and operation, so that many copies of a key meet the table as one.
    keyed = changes.where(~keys.any_null(key)).select(*key, "op").distinct()
    existing = current.select(*key).join(hint(keyed.select(*key).distinct(), table.name), key, "left_semi")
    # An update of a row that is not there changes nothing; it is reported, not silently dropped.
    return [
        _label(keyed.where(F.col("op") == INSERT).join(existing, key, "left_semi"), table.primary_key, "unique", rule),
        _label(keyed.where(F.col("op") == UPDATE).join(existing, key, "left_anti"), table.primary_key, "missing", rule),
        _label(keys.duplicates(changes, key), table.primary_key, "unique", rule),
    ]


def _unique_breaches(changes: DataFrame, current: DataFrame, table: Table, hint: _Hint) -> list[DataFrame]:
    """Unique values held by another current row or claimed by another change."""
    key, found = list(table.primary_key), []
    for unique in table.uniques:
        columns, rule = list(unique), "_".join(unique)
        claims = changes.where(~keys.any_null(columns)).select(*key, *columns)
        wanted = hint(claims.select(*columns).distinct())
        held = current.select(*columns, F.struct(*key).alias("holder")).join(wanted, columns, "left_semi")
        taken = lookup(claims, held, columns, broadcast_rows=0).where(F.struct(*key) != F.col("holder"))
        found.append(_label(taken, table.primary_key, "unique", rule))
        shared = keys.duplicates(claims, columns)
        found.append(_label(lookup(claims, shared, columns, broadcast_rows=0), table.primary_key, "unique", rule))
    return found


def _reference_breaches(
    changes: DataFrame, table: Table, parents: dict[str, DataFrame], hint: _Hint, fresh: dict[str, DataFrame] | None = None
) -> list[DataFrame]:
    """Claims on keys that neither the current parents nor the ``fresh`` rows of the same set hold."""
    found = []
    for r in table.references:
        claims = changes.where(F.col(r.column).isNotNull()).select(*table.primary_key, r.column)
        wanted = claims.select(r.column).distinct()
        known = parents[r.table].select(F.col(r.key).alias(r.column)).join(hint(wanted, r.table), r.column, "left_semi")
        if r.table in (fresh or {}):
            known = known.union(fresh[r.table].select(F.col(r.key).cast(known.schema[r.column].dataType))).distinct()
        missing = wanted.join(hint(known), r.column, "left_anti")
        found.append(_label(lookup(claims, missing, r.column, broadcast_rows=0), table.primary_key, "foreign_key", r.column))
    return found


def _own_breaches(changes: DataFrame, table: Table, current: DataFrame, hint: _Hint) -> list[DataFrame]:
    return [
        _row_breaches(changes, table),
        *_key_breaches(changes, current, table, hint),
        *_unique_breaches(changes, current, table, hint),
    ]


def screen(
    changes: DataFrame, table: Table, current: DataFrame, parents: dict[str, DataFrame], hint: _Hint | None = None
) -> DataFrame:
    """(key, violation, rule): one row per broken rule. ``changes`` holds whole new rows plus ``op``."""
    hint = hint or _Hint(changes)
    found = [*_own_breaches(changes, table, current, hint), *_reference_breaches(changes, table, parents, hint)]
    return union_all(found).distinct()


def _node(name: str, columns: list[str]) -> Expr:
    """A row's name in the graph of references: its table and key."""
    return F.concat(F.lit(f"{name}:"), F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def _claims(changes: DataFrame, table: Table, tables: dict[str, DataFrame], hint: _Hint, good: dict[str, DataFrame]) -> list[DataFrame]:
    """(key, rule, a, b): claims of changes on keys that no current parent holds; ``b`` is the change that brings it, or NULL.

    ``good`` holds the changes of each table that break no rule of their own, so a key is brought by one of them at most.
    """
    found = []
    for r in table.references:
        claims = changes.where(F.col(r.column).isNotNull()).select(*table.primary_key, r.column, _node(table.name, list(table.primary_key)).alias("a"))
        wanted = claims.select(r.column).distinct()
        known = tables[r.table].select(F.col(r.key).alias(r.column)).join(hint(wanted), r.column, "left_semi")
        open_ = wanted.join(hint(known), r.column, "left_anti")
        if r.table in good:
            bringing = good[r.table].select(F.col(r.key).cast(changes.schema[r.column].dataType).alias(r.column), F.col("node__").alias("b"))
            open_ = open_.join(bringing, r.column, "left")
        else:
            open_ = open_.withColumn("b", F.lit(None).cast("string"))
        found.append(lookup(claims, open_, r.column, broadcast_rows=0).select(*table.primary_key, F.lit(r.column).alias("rule"), "a", "b"))
    return found


def batch(changes: dict[str, DataFrame], contract: Contract, tables: dict[str, DataFrame]) -> dict[str, Outcome]:
    """Apply change sets of several tables together, as one statement would: a row may refer to a row of the same batch.

    Changes that break a rule of their own, or whose parent is neither a current row nor brought by the batch, are
    rejected, and with them every change that depends on one of them, at any distance. The current tables are read once, for
    the keys that the changes claim; the rest is a walk over the references inside the batch (``closure.spread``),
    whose rounds follow the logarithm of the longest chain. Changes that only depend on each other are good.
    """
    changes = {name: cut_lineage(df) for name, df in changes.items()}
    hints = {name: _Hint(df) for name, df in changes.items()}
    own = {name: cut_lineage(union_all(_own_breaches(df, contract[name], tables[name], hints[name])).distinct()) for name, df in changes.items()}
    named, good = {}, {}
    for name, df in changes.items():
        key = list(contract[name].primary_key)
        named[name] = df.withColumn("node__", _node(name, key))
        good[name] = named[name].where(~keys.any_null(key)).join(hints[name](own[name].select(*key).distinct()), key, "left_anti")
    claims = {name: [cut_lineage(c) for c in _claims(df, contract[name], tables, hints[name], good)] for name, df in changes.items()}
    every = [c.select("a", "b") for found in claims.values() for c in found]
    bad = union_all([own[name].select(_node(name, list(contract[name].primary_key)).alias("node")) for name in changes])
    if every:
        graph = union_all(every)
        bad = closure.spread(graph.where("b IS NOT NULL"), bad.union(graph.where("b IS NULL").select("a")), closure.BACKWARDS)
    bad = cut_lineage(bad.distinct())
    outcomes = {}
    for name, df in named.items():
        key = list(contract[name].primary_key)
        broken = bad.select(F.col("node").alias("b"), F.lit(True).alias("bad"))
        found = [_label(lookup(c, broken, "b", "left", broadcast_rows=0).where("b IS NULL OR bad").withColumnRenamed("rule", "rule__"), tuple([*key, "rule__"]), "foreign_key", "")
                 .select(*key, "violation", F.col("rule__").alias("rule")) for c in claims[name]]
        rejected = cut_lineage(union_all([own[name], *found]).distinct())
        accepted = df.where(~keys.any_null(key)).join(bad.select(F.col("node").alias("node__")), "node__", "left_anti")
        fresh = conform(accepted.drop("node__"), contract[name])
        kept = tables[name].join(hints[name](fresh.select(*key)), key, "left_anti").select(*tables[name].columns)
        outcomes[name] = Outcome(kept.unionByName(fresh), rejected)
    return outcomes


def upsert(
    changes: DataFrame,
    table: Table,
    current: DataFrame,
    parents: dict[str, DataFrame],
    buckets: dict[str, int] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> Outcome:
    """Apply inserts and updates that break no rule.

    The change set and the verdict are written once to the checkpoint folder, as both results need them. The current table
    is only filtered by the accepted keys, with a broadcast when the change set is small, so a small change
    set does not shuffle a large table. ``buckets`` names the tables, ``table`` or parents, that are bucketed by the key that the
    set meets them by, with their numbers of buckets (``sources.bucketed``): a large set does not shuffle these either.
    Only unique values, which no primary key's buckets serve, still bring their columns together by a shuffle.
    """
    key = list(table.primary_key)
    changes = cut_lineage(changes)  # every rule reads the set; it is computed once
    hint = _Hint(changes, buckets, broadcast_rows)
    rejected = cut_lineage(screen(changes, table, current, parents, hint))
    # A row whose key is NULL cannot be matched by an equi-join; it always breaks not_null.
    dealt = hint.dealt(changes.where(~keys.any_null(key)), table)
    accepted = dealt.join(hint(rejected.select(*key).distinct()), key, "left_anti")
    fresh = conform(accepted, table)
    kept = current.join(hint(fresh.select(*key), table.name), key, "left_anti").select(*current.columns)
    return Outcome(kept.unionByName(fresh), rejected)


def delete(
    current: DataFrame, condition: Expr, table: Table, children: dict[str, tuple[DataFrame, str]]
) -> Outcome:
    """Delete rows unless a child still refers to them. ``children`` maps rule name to (child, column)."""
    (key,) = table.primary_key
    doomed = current.where(condition).select(key)
    rejected = cut_lineage(_blocked(doomed, table, children, _Hint(doomed)))
    removable = doomed.join(_Hint(doomed)(rejected.select(key).distinct()), key, "left_anti")
    return Outcome(current.join(_Hint(doomed)(removable), key, "left_anti").select(*current.columns), rejected)


def _blocked(doomed: DataFrame, table: Table, children: dict[str, tuple[DataFrame, str]], hint: _Hint) -> DataFrame:
    (key,) = table.primary_key
    blocked = []
    for rule, (child, column) in children.items():
        # Few doomed keys filter the child table before it is grouped; many keys meet it after.
        near = child.join(F.broadcast(doomed.withColumnRenamed(key, column)), column, "left_semi") if hint.small else child
        used = keys.referenced(near, column, key).select(key)
        blocked.append(_label(doomed.join(used, key, "left_semi"), table.primary_key, "foreign_key", rule))
    return union_all(blocked)


def delete_batch(doomed: dict[str, DataFrame], contract: Contract, tables: dict[str, DataFrame]) -> dict[str, Outcome]:
    """Delete rows of several tables together: only children that stay keep their parents.

    ``doomed`` holds key rows per table. A row that a staying child refers to stays and is reported; it may keep its own
    parents, and so on. Every child table is read once for its staying rows and once for its doomed ones; what follows is a walk
    over the references between doomed rows (``closure.spread``), whose rounds follow the logarithm of the longest chain.
    References of a table to itself count like others.
    """
    doomed = {name: cut_lineage(tables[name].select(*contract[name].primary_key).join(df, list(contract[name].primary_key), "left_semi").distinct())
              for name, df in doomed.items()}
    hints = {name: _Hint(df) for name, df in doomed.items()}
    blocked: dict[str, list[DataFrame]] = {name: [] for name in doomed}  # (key, violation, rule) by rows that stay in any case
    held: dict[str, list[DataFrame]] = {name: [] for name in doomed}  # (key, rule, a, b): a doomed child and its doomed parent
    for t in contract.tables:
        own_key = list(t.primary_key)
        staying = tables[t.name].join(hints[t.name](doomed[t.name]), own_key, "left_anti") if t.name in doomed else tables[t.name]
        for r in t.references:
            if r.table not in doomed:
                continue
            (key,) = contract[r.table].primary_key
            rule = f"{t.name}.{r.column}"
            blocked[r.table].append(cut_lineage(_blocked(doomed[r.table], contract[r.table], {rule: (staying, r.column)}, hints[r.table]).distinct()))
            if t.name in doomed:
                leaving = tables[t.name].join(hints[t.name](doomed[t.name]), own_key, "left_semi").where(F.col(r.column).isNotNull())
                claims = leaving.select(F.col(r.column).cast(doomed[r.table].schema[key].dataType).alias(key), _node(t.name, own_key).alias("a"))
                parents = doomed[r.table].select(key, _node(r.table, [key]).alias("b"))
                held[r.table].append(cut_lineage(lookup(claims, parents, key, broadcast_rows=0).select(key, F.lit(rule).alias("rule"), "a", "b")))
    direct = [b.select(_node(name, list(contract[name].primary_key)).alias("node")) for name, found in blocked.items() for b in found]
    inside = [e.select("a", "b") for found in held.values() for e in found]
    stays = union_all(direct) if direct else None
    if direct and inside:
        stays = closure.spread(union_all(inside), stays, closure.FORWARDS)
    stays = cut_lineage(stays.distinct()) if stays is not None else None
    outcomes = {}
    for name, df in doomed.items():
        key = list(contract[name].primary_key)
        if stays is None or not blocked[name]:
            leaving, rejected = df, _label(df.limit(0), contract[name].primary_key, "", "")
        else:
            kept = stays.select(F.col("node").alias("a"), F.lit(True).alias("stays"))
            passed = [lookup(e, kept, "a", broadcast_rows=0).select(*key, F.lit("foreign_key").alias("violation"), "rule") for e in held[name]]
            rejected = cut_lineage(union_all([*blocked[name], *passed]).distinct())
            leaving = df.join(rejected.select(*key).distinct(), key, "left_anti")
        outcomes[name] = Outcome(tables[name].join(hints[name](leaving), key, "left_anti").select(*tables[name].columns), rejected)
    return outcomes
