"""Contract, edge-case, chronology and distribution checks over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.contract import counts, verify
from cartloom.operators import commerce, keys, ordered
from cartloom.operators.diff import relation_diff
from cartloom.operators.profiling import date_ranges as date_ranges_of
from cartloom.operators.profiling import facts, frequencies, outside_envelope, text, union_all, unpivot
from cartloom.operators.profiling import null_counts as null_counts_of
from cartloom.operators.profiling import row_counts as row_counts_of
from cartloom.operators.skew import lookup
from cartloom.plans.digests import NEXT_SQL, next_orders
from cartloom.plans.registry import Registry
from cartloom.plans.star import LINE_KEY, STAR, as_double, dec, table, tables
from cartloom.session import shared_folder
from cartloom.sources import snapshot

QUERIES = Registry()

# -- structural rules --------------------------------------------------------------------------------------

# Expected columns as plain text: table, column, Spark type.
DECLARED = [(t.name, c.name, c.type) for t in STAR.tables for c in t.columns]

# Spark's names of the types that the SQL engine reports.
TYPE_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean"}


def _type_sql(table_name: str, column: str) -> str:
    """The type a column has, in Spark's words; text for a table without rows is NULL."""
    cases = " ".join(f"WHEN '{theirs}' THEN '{ours}'" for theirs, ours in TYPE_NAMES.items())
    return f"(SELECT CASE typeof({column}) {cases} END FROM {table_name} LIMIT 1)"


SCHEMA_SQL = "\nUNION ALL ".join(
    [f"SELECT 'table_set' AS \"check\", '{t.name}' AS subject, '= 0' AS expected, (count(*) = 0)::BIGINT AS observed, count(*) > 0 AS passed"
     f" FROM duckdb_views() WHERE view_name = '{t.name}'" for t in STAR.tables]
    + [f"SELECT 'column', '{t}.{c}', '= 0', (k <> '{kind}')::BIGINT, k = '{kind}' FROM (SELECT {_type_sql(t, c)} AS k)" for t, c, kind in DECLARED]
)


def _report_sql(kind: str, subject: str, observed: str, source: str) -> str:
    return (
        f"SELECT '{kind}' AS \"check\", '{subject}' AS subject, '= 0' AS expected, n::BIGINT AS observed, n = 0 AS passed"
        f" FROM (SELECT {observed} AS n FROM {source})"
    )


def _rules_sql(kinds: tuple[str, ...]) -> list[str]:
    parts = []
    for t in STAR.tables:
        for kind, name, rule in t.row_rules():
            if kind in kinds:
                condition = rule.replace("char_length", "length")
                parts.append(_report_sql(kind, f"{t.name}.{name}", f"count(*) FILTER (WHERE NOT ({condition}))", t.name))
    return parts


def _keys_sql() -> list[str]:
    parts = []
    for t in STAR.tables:
        for kind, columns in [("primary_key", t.primary_key), *(("unique", u) for u in t.uniques)]:
            listed = ", ".join(columns)
            present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
            # Rows beyond the first of each key: all rows minus distinct keys.
            parts.append(_report_sql(
                kind, f"{t.name}.{'_'.join(columns)}", "sum(n) - count(*)",
                f"(SELECT count(*) AS n FROM {t.name} WHERE {present} GROUP BY {listed})",
            ))
    return parts


def _references_sql() -> list[str]:
    return [
        _report_sql(
            "foreign_key", f"{t.name}.{r.column}", "count(*)",
            f"{t.name} c LEFT JOIN {r.table} p ON c.{r.column} = p.{r.key} WHERE c.{r.column} IS NOT NULL AND p.{r.key} IS NULL",
        )
        for t in STAR.tables
        for r in t.references
    ]


@QUERIES.add("schema_contract", "\nUNION ALL ".join(
    f"SELECT '{t.name}' AS table_name, '{c.name}' AS column_name, {i} AS position, '{c.type}' AS declared_type,"
    f" {_type_sql(t.name, c.name)} AS actual_type, count(*) FILTER (WHERE {c.name} IS NULL) AS nulls,"
    f" count(*) FILTER (WHERE {c.name} IS NULL) = 0 AND {_type_sql(t.name, c.name)} = '{c.type}' AS passed FROM {t.name}"
    for t in STAR.tables for i, c in enumerate(t.columns, start=1)))
def schema_contract(spark, folder):
    return verify.column_report(STAR, tables(spark, folder))


@QUERIES.add("row_counts", "\nUNION ALL ".join(
    f"SELECT '{t.name}' AS table_name, count(*) AS row_count FROM {t.name}" for t in STAR.tables))
def row_counts(spark, folder):
    return row_counts_of(tables(spark, folder))


# What the row counts should be, by rules that only some tables follow: keys are dense from 0, and an order has three lines.
EXPECTED_ROWS = {"customer": ("customer", "max(c_custkey) + 1"), "part": ("part", "max(p_partkey) + 1"), "orders": ("orders", "max(o_orderkey) + 1"),
                 "lineitem": ("orders", "3 * count(*)"), "events": ("customer", "10 * count(*)"), "supplier": ("supplier", "max(s_suppkey) + 1")}


@QUERIES.add("count_mismatch", "\nUNION ALL ".join(f"""
SELECT '{t}' AS table_name, (SELECT {rule} FROM {source})::BIGINT AS expected, count(*) AS row_count FROM {t}
HAVING count(*) <> (SELECT {rule} FROM {source})""" for t, (source, rule) in EXPECTED_ROWS.items()))
def count_mismatch(spark, folder):
    """Tables whose rows differ in number from an expected relation."""
    given = tables(spark, folder)
    expected = union_all([
        given[source].agg(F.expr(rule).cast("bigint").alias("expected")).select(F.lit(t).alias("table_name"), "expected")
        for t, (source, rule) in EXPECTED_ROWS.items()
    ])
    return expected.join(row_counts_of(given), "table_name").where("expected <> row_count").select("table_name", "expected", "row_count")


@QUERIES.add("null_counts", "\nUNION ALL ".join(
    f"SELECT '{t}.{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {t}" for t, c, _ in DECLARED))
def null_counts(spark, folder):
    return null_counts_of(tables(spark, folder))


@QUERIES.add("check_rows", "\nUNION ALL ".join(_rules_sql(("length", "check"))))
def check_rows(spark, folder):
    return verify.scan_rules(STAR, tables(spark, folder), ("length", "check"))


@QUERIES.add("contract_report", "\nUNION ALL ".join(
    [SCHEMA_SQL, *_rules_sql(("not_null", "length", "check")), *_keys_sql(), *_references_sql()]))
def contract_report(spark, folder):
    return verify.structural(spark, STAR, tables(spark, folder))


@QUERIES.add("contract_observed", "\nUNION ALL ".join(_rules_sql(("not_null", "length", "check"))))
def contract_observed(spark, folder):
    """The row rules of the report, measured by the jobs that stage a snapshot of the tables."""
    root = shared_folder(spark, "observed-snapshot")
    observer = verify.Observer({t.name: verify.row_measures(t) for t in STAR.tables})
    version = snapshot.stage(spark, tables(spark, folder), root, clustering={}, observer=observer)
    return snapshot.observed(spark, root, version, observer)


def _inventory_sql() -> str:
    """The declared rules, the rules that the tables bear out, and what only one of both has."""
    declared = ", ".join("(" + ", ".join("'" + part.replace("'", "''") + "'" for part in entry) + ")" for entry in STAR.entries())
    columns = []
    for t in STAR.tables:
        for i, c in enumerate(t.columns, start=1):
            longest = f"coalesce('(' || max(length({c.name})) || ')', '')" if c.type == "string" else "''"
            columns.append(f"SELECT 'column', '{t.name}.{c.name}', '{i} {c.type}' || {longest}"
                           f" || if(count(*) FILTER (WHERE {c.name} IS NULL) = 0, ' NOT NULL', '') FROM {t.name}")
    report = "\nUNION ALL ".join([*_rules_sql(("check",)), *_keys_sql(), *_references_sql()])
    found = "\nUNION ALL ".join(columns)
    return f"""
WITH declared(kind, name, definition) AS (VALUES {declared}), report AS ({report}), found(kind, name, definition) AS (
{found}
UNION ALL SELECT kind, name, definition FROM declared WHERE (kind, name) IN (SELECT ("check", subject) FROM report WHERE passed))
SELECT 'declared' AS side, * FROM (SELECT * FROM declared EXCEPT SELECT * FROM found)
UNION ALL SELECT 'found', * FROM (SELECT * FROM found EXCEPT SELECT * FROM declared)"""


@QUERIES.add("rule_inventory", _inventory_sql())
def rule_inventory(spark, folder):
    """Where the contract's inventory and the rules that the tables bear out differ."""
    return relation_diff(STAR.catalog(spark), verify.found_inventory(STAR, tables(spark, folder)), "declared", "found")


_COUNTED = "SELECT 'orders' AS table_name, count(*) AS n FROM {} UNION ALL SELECT 'customer', count(*) FROM customer"


@QUERIES.add("count_contracts", f"""
SELECT table_name, l.n AS left_rows, r.n AS right_rows
FROM ({_COUNTED.format('orders')} UNION ALL SELECT 'part', count(*) FROM part) l
FULL JOIN ({_COUNTED.format(f'({NEXT_SQL})')} UNION ALL SELECT 'supplier', count(*) FROM supplier) r USING (table_name)
WHERE l.n IS DISTINCT FROM r.n""")
def count_contracts(spark, folder):
    """Tables whose rows two versions count differently, or only one of them has."""
    given = tables(spark, folder)
    before = {name: given[name] for name in ("orders", "customer", "part")}
    after = {"orders": next_orders(given["orders"]), "customer": given["customer"], "supplier": given["supplier"]}
    return counts.compare(row_counts_of(before), row_counts_of(after))


@QUERIES.add("pk_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL HAVING count(*) > 1""")
def pk_violations(spark, folder):
    return keys.duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@QUERIES.add("unique_violations", """
SELECT p_name, count(*) AS copies FROM part WHERE p_name IS NOT NULL GROUP BY p_name HAVING count(*) > 1""")
def unique_violations(spark, folder):
    return keys.duplicates(table(spark, folder, "part"), ["p_name"])


# child table, foreign key, parent table, primary key
RELATIONS = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    # Not references in the data model: these have orphans.
    ("events", "user_id", "supplier", "s_suppkey"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
]


@QUERIES.add("fk_orphans", "\nUNION ALL ".join(f"""
SELECT '{c}.{f} -> {p}.{k}' AS relation, count(*) AS orphan_keys, coalesce(sum(n), 0)::BIGINT AS orphan_rows
FROM (SELECT {f}, count(*) AS n FROM {c} WHERE {f} IS NOT NULL AND {f} NOT IN (SELECT {k} FROM {p} WHERE {k} IS NOT NULL) GROUP BY {f})"""
    for c, f, p, k in RELATIONS))
def fk_orphans(spark, folder):
    """All references to a parent are answered by one grouping of its keys and those of its children; nothing is joined."""
    parents = dict.fromkeys((p, k) for _, _, p, k in RELATIONS)
    found = []
    for p, k in parents:
        children = [(c, f) for c, f, parent, key in RELATIONS if (parent, key) == (p, k)]
        profile = keys.reference_profile(table(spark, folder, p), k, [(table(spark, folder, c), f) for c, f in children])
        sums = [expression for i in range(len(children)) for expression in (
            F.count_if((F.col("in_parent") == 0) & (F.col(f"in_child_{i}") > 0)).alias(f"keys_{i}"),
            F.coalesce(F.sum(F.when(F.col("in_parent") == 0, F.col(f"in_child_{i}"))), F.lit(0)).alias(f"rows_{i}"))]
        found.append(unpivot(profile.agg(*sums), [
            {"relation": text(f"{c}.{f} -> {p}.{k}"), "orphan_keys": f"keys_{i}", "orphan_rows": f"rows_{i}"} for i, (c, f) in enumerate(children)]))
    return union_all(found)


# parent table, primary key, child table, foreign key
CHILDREN = [
    ("customer", "c_custkey", "orders", "o_custkey"),
    ("part", "p_partkey", "lineitem", "l_partkey"),
    ("supplier", "s_suppkey", "lineitem", "l_suppkey"),
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ("customer", "c_custkey", "events", "user_id"),
    ("documents", "doc_id", "labels", "doc_id"),
]


@QUERIES.add("keys_without_children", "\nUNION ALL ".join(f"""
SELECT '{p} without {c}' AS relation, count(*) AS childless FROM {p} p WHERE NOT EXISTS (SELECT 1 FROM {c} c WHERE c.{f} = p.{k})"""
    for p, k, c, f in CHILDREN))
def keys_without_children(spark, folder):
    return union_all([
        keys.without_children(table(spark, folder, p).select(k), k, table(spark, folder, c), f)
        .agg(F.count(F.lit(1)).alias("childless"))
        .select(F.lit(f"{p} without {c}").alias("relation"), "childless")
        for p, k, c, f in CHILDREN
    ])


# -- distributions -----------------------------------------------------------------------------------------

GROUPED = [
    ("orders", "o_custkey"), ("orders", "o_orderpriority"), ("customer", "c_nationkey"), ("events", "user_id"),
    ("events", "event_type"), ("lineitem", "l_suppkey"),
]


@QUERIES.add("high_volume_keys", "\nUNION ALL ".join(f"""
SELECT '{t}.{c}' AS key_column, {c}::VARCHAR AS key, count(*) AS row_count FROM {t} GROUP BY {c}
HAVING count(*) >= (SELECT count(*) // 20 FROM {t})""" for t, c in GROUPED))
def high_volume_keys(spark, folder):
    """Keys that hold at least a twentieth of the rows of their table."""
    frames = []
    for name, column in GROUPED:
        df = table(spark, folder, name)
        twentieth = df.agg(F.expr("count(1) div 20")).scalar()
        frames.append(
            frequencies(df, column).where(F.col("row_count") >= twentieth).select(
                F.lit(f"{name}.{column}").alias("key_column"), F.col(column).cast("string").alias("key"), "row_count"
            )
        )
    return union_all(frames)


TENTHS = [("orders", "o_custkey", "customer"), ("lineitem", "l_partkey", "part"), ("events", "user_id", "customer")]


@QUERIES.add("top_key_share", "\nUNION ALL ".join(f"""
SELECT '{t}.{c}' AS key_column, (count(*) FILTER (WHERE {c} < (SELECT count(*) // 10 FROM {p})) * 1000000 // count(*))::BIGINT AS share_ppm FROM {t}"""
    for t, c, p in TENTHS))
def top_key_share(spark, folder):
    """Share of rows held by the lowest tenth of the keys, in parts per million."""
    frames = []
    for name, column, parent in TENTHS:
        tenth = table(spark, folder, parent).agg(F.expr("count(1) div 10")).scalar()
        # The bound is attached before the aggregate; it is one literal value for the whole scan.
        rows = table(spark, folder, name).select((F.col(column) < tenth).alias("low"))
        frames.append(rows.agg(F.expr("count_if(low) * 1000000 div nullif(count(1), 0)").alias("share_ppm")).select(
            F.lit(f"{name}.{column}").alias("key_column"), "share_ppm"))
    return union_all(frames)


SEASONS = [("orders", "o_orderdate", "2000-10-01"), ("lineitem", "l_shipdate", "2000-10-01"), ("events", "ts", "2024-01-24")]


@QUERIES.add("season_share", "\nUNION ALL ".join(f"""
SELECT '{t}.{c}' AS column_name, (count(*) FILTER (WHERE {c} >= TIMESTAMP '{d}') * 1000000 // count(*))::BIGINT AS share_ppm FROM {t}"""
    for t, c, d in SEASONS))
def season_share(spark, folder):
    return union_all([
        table(spark, folder, t).agg(
            F.expr(f"count_if({c} >= timestamp_ntz'{d}') * 1000000 div nullif(count(1), 0)").alias("share_ppm")
        ).select(F.lit(f"{t}.{c}").alias("column_name"), "share_ppm")
        for t, c, d in SEASONS
    ])


STATUSES = [("orders", "o_orderstatus"), ("lineitem", "l_linestatus"), ("events", "event_type")]


@QUERIES.add("status_counts", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, {c} AS status, count(*) AS row_count FROM {t} GROUP BY {c}" for t, c in STATUSES))
def status_counts(spark, folder):
    return union_all([
        frequencies(table(spark, folder, t), c).select(F.lit(t).alias("table_name"), F.col(c).alias("status"), "row_count")
        for t, c in STATUSES
    ])


MOMENTS = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]


@QUERIES.add("date_ranges", "\nUNION ALL ".join(
    f"SELECT '{t}.{c}' AS column_name, min({c}) AS first_at, max({c}) AS last_at FROM {t}" for t, c in MOMENTS))
def date_ranges(spark, folder):
    return date_ranges_of(tables(spark, folder))


@QUERIES.add("date_envelope", "\nUNION ALL ".join(f"""
SELECT '{t}.{c}' AS column_name, count(*) FILTER (WHERE {c} < TIMESTAMP '1995-02-01' OR {c} >= TIMESTAMP '2001-08-01') AS violations FROM {t}"""
    for t, c in MOMENTS))
def date_envelope(spark, folder):
    return outside_envelope(
        tables(spark, folder), F.expr("timestamp_ntz'1995-02-01 00:00:00'"), F.expr("timestamp_ntz'2001-08-01 00:00:00'")
    )


# -- cross-table checks ------------------------------------------------------------------------------------


@QUERIES.add("order_total_reconciliation", """
SELECT o_orderkey, o_totalprice, t.cents::DOUBLE / 100 AS line_total
FROM orders LEFT JOIN (SELECT l_orderkey, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cents FROM lineitem GROUP BY l_orderkey) t
  ON l_orderkey = o_orderkey
WHERE round(o_totalprice * 100)::BIGINT IS DISTINCT FROM t.cents""")
def order_total_reconciliation(spark, folder):
    claims = table(spark, folder, "orders").select("o_orderkey", dec("o_totalprice").alias("o_totalprice"))
    found = commerce.total_mismatches(
        claims, "o_orderkey", "o_totalprice", table(spark, folder, "lineitem"), "l_orderkey", dec("l_extendedprice")
    )
    return as_double(found, "o_totalprice", "line_total")


@QUERIES.add("price_drift", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate, l_quantity, l_extendedprice, p_retailprice
FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE round(l_extendedprice * 100)::BIGINT <> round(l_quantity * 100)::BIGINT * round(p_retailprice * 100)::BIGINT // 100""")
def price_drift(spark, folder):
    """Lines whose amount is not quantity times the current list price."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").alias("p_partkey"), "l_shipdate", "l_quantity", "l_extendedprice"
    )
    prices = table(spark, folder, "part").select("p_partkey", "p_retailprice")
    drifted = lookup(lines, prices, "p_partkey").where(
        dec("l_extendedprice") != (dec("l_quantity") * dec("p_retailprice")).cast("decimal(18,2)")
    )
    return drifted.withColumnRenamed("p_partkey", "l_partkey")


@QUERIES.add("chronology_violations", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderdate
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate""")
def chronology_violations(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return lookup(lines, orders, "l_orderkey").where("l_shipdate < o_orderdate")


@QUERIES.add("shipment_consistency", """
SELECT o_orderkey, o_orderstatus, lines, open_lines, first_ship
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines, count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines,
                              min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
WHERE (o_orderstatus IN ('F', 'O')) IS DISTINCT FROM (lines IS NOT NULL) OR first_ship < o_orderdate
   OR (o_orderstatus = 'F' AND open_lines > 0)""")
def shipment_consistency(spark, folder):
    """Orders whose state does not agree with the existence, dates and state of their lines."""
    lines = _line_state(spark, folder)
    expected = F.col("o_orderstatus").isin("F", "O")
    wrong = (
        ~expected.eqNullSafe(F.col("lines").isNotNull())
        | (F.col("first_ship") < F.col("o_orderdate"))
        | ((F.col("o_orderstatus") == "F") & (F.col("open_lines") > 0))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return orders.join(lines, "o_orderkey", "left").where(wrong).drop("o_orderdate")


def _line_state(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        F.min("l_shipdate").alias("first_ship"),
    )


@QUERIES.add("timestamp_ties", """
SELECT o_custkey, o_orderdate, count(*) AS orders FROM orders GROUP BY ALL HAVING count(*) > 1""")
def timestamp_ties(spark, folder):
    return table(spark, folder, "orders").groupBy("o_custkey", "o_orderdate").agg(
        F.count(F.lit(1)).alias("orders")
    ).where("orders > 1")


@QUERIES.add("history_order_violations", """
SELECT o_custkey, o_orderdate, o_orderkey FROM (
  SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM orders)
WHERE previous >= o_orderdate""")
def history_order_violations(spark, folder):
    """A customer's orders that do not follow a strictly earlier one."""
    return commerce.unordered_events(table(spark, folder, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey")


@QUERIES.add("status_mismatch", """
SELECT c_custkey, if(c_acctbal < 2000, 'error', 'purchase') AS expected_status, latest_status
FROM customer LEFT JOIN (
  SELECT user_id, event_type AS latest_status FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) ON user_id = c_custkey
WHERE expected_status IS DISTINCT FROM latest_status""")
def status_mismatch(spark, folder):
    """Customers whose last event is not the expected one, or who have none."""
    expected = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 2000, "error").otherwise("purchase").alias("expected_status")
    )
    events = table(spark, folder, "events").withColumnRenamed("user_id", "c_custkey")
    latest = ordered.ends(events, ["c_custkey"], ["ts", "event_id"], last={"latest_status": "event_type"})
    return commerce.status_mismatches(expected, "c_custkey", "expected_status", latest, "latest_status")


@QUERIES.add("edge_case_report", """
SELECT 'customers_without_orders' AS fact, count(*) AS value FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'orders_without_lines', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'open_orders', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'returned_lines', count(*) FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'users_with_many_events', count(*) FROM (SELECT user_id FROM events GROUP BY user_id HAVING count(*) > 70)
UNION ALL SELECT 'error_only_user_days', count(*) FROM (
  SELECT user_id, ts::DATE FROM events GROUP BY ALL HAVING bool_and(event_type = 'error'))""")
def edge_case_report(spark, folder):
    t = tables(spark, folder)
    per_user = frequencies(t["events"], "user_id")
    per_day = t["events"].groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.bool_and(F.col("event_type") == "error").alias("only_errors")
    )
    return facts({
        "customers_without_orders": keys.without_children(t["customer"].select("c_custkey"), "c_custkey", t["orders"], "o_custkey"),
        "orders_without_lines": keys.without_children(t["orders"].select("o_orderkey"), "o_orderkey", t["lineitem"], "l_orderkey"),
        "open_orders": t["orders"].where("o_orderstatus = 'O'"),
        "returned_lines": t["lineitem"].where("l_returnflag = 'R'"),
        "users_with_many_events": per_user.where("row_count > 70"),
        "error_only_user_days": per_day.where("only_errors"),
    })


@QUERIES.add("dense_row_number", f"""
SELECT {', '.join(LINE_KEY)}, row_number() OVER (ORDER BY {', '.join(LINE_KEY)}) AS row_number FROM lineitem""")
def dense_row_number(spark, folder):
    return ordered.dense_row_number(table(spark, folder, "lineitem").select(*LINE_KEY), LINE_KEY)


@QUERIES.add("dense_row_number_cut", QUERIES["dense_row_number"].sql)
def dense_row_number_cut(spark, folder):
    """The same numbering with the one group of all lines cut every few thousand rows, as in large tables."""
    return ordered.dense_row_number(table(spark, folder, "lineitem").select(*LINE_KEY), LINE_KEY, task_rows=5_000)
