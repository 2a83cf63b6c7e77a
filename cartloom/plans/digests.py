"""Fingerprints and version differences of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.operators import diff, digest_tree, fingerprint
from cartloom.plans.registry import Registry
from cartloom.plans.star import STAR, as_double, table
from cartloom.session import shared_folder

QUERIES = Registry()

PRINTED = STAR.names
TREE_DIGITS = 2


def _exact(df: DataFrame) -> DataFrame:
    """Amounts as decimals, so that their text does not depend on a double printer."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in doubles})


def _json_sql(name: str) -> str:
    """Canonical JSON text of a row, spelled out by concatenation."""
    printed = []
    for c in STAR[name].columns:
        if c.type == "string":
            value = f"""'"' || replace(replace({c.name}, '\\', '\\\\'), '"', '\\"') || '"'"""
        elif c.type == "double":
            value = f"{c.name}::DECIMAL(12,2)::VARCHAR"
        elif c.type == "timestamp_ntz":
            value = f"""'"' || replace({c.name}::VARCHAR, ' ', 'T') || '+00:00"'"""
        else:
            value = f"{c.name}::VARCHAR"
        printed.append(f"""'"{c.name}":' || coalesce({value}, 'null')""")
    return "'{' || " + " || ',' || ".join(printed) + " || '}'"


@QUERIES.add("row_digest", f"SELECT event_id, md5({_json_sql('events')}) AS digest FROM events")
def row_digest(spark, folder):
    return fingerprint.row_digests(_exact(table(spark, folder, "events")), keep=["event_id"])


def _lanes_sql(digests: str, labels: str = "") -> str:
    lanes = ", ".join(f"sum(('0x' || substr(d, {first}, 15))::BIGINT)::VARCHAR AS {lane}" for first, lane in ((1, "lane_a"), (16, "lane_b")))
    return f"SELECT {labels}count(*) AS row_count, {lanes} FROM ({digests})"


def _lanes_as_text(prints: DataFrame) -> DataFrame:
    return prints.withColumns({lane: F.col(lane).cast("string") for lane in ("lane_a", "lane_b")})


@QUERIES.add("table_fingerprint", "\nUNION ALL ".join(
    _lanes_sql(f"SELECT md5({_json_sql(t)}) AS d FROM {t}", f"'{t}' AS table_name, ") for t in PRINTED))
def table_fingerprint(spark, folder):
    return _lanes_as_text(fingerprint.of_tables({t: _exact(table(spark, folder, t)) for t in PRINTED}))


@QUERIES.add("table_fingerprint_bucketed",
             _lanes_sql(f"SELECT md5({_json_sql('orders')}) AS d FROM orders", f"substr(d, 1, {TREE_DIGITS}) AS bucket, ") + " GROUP BY bucket")
def table_fingerprint_bucketed(spark, folder):
    """Sums of the orders' digests per digest prefix, over all columns."""
    return _lanes_as_text(fingerprint.bucketed(_exact(table(spark, folder, "orders")), TREE_DIGITS))


# -- two versions of the orders ----------------------------------------------------------------------------

# Version two closes old pending orders, drops finished low-priority ones, and reopens urgent ones under new keys.
NEXT_SQL = """
  SELECT o_orderkey, o_custkey, if(o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01', 'F', o_orderstatus) AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')
  UNION ALL
  SELECT o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders), o_custkey, 'O', o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"""


def next_orders(orders: DataFrame) -> DataFrame:
    closing = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.expr("timestamp_ntz'1998-01-01 00:00:00'"))
    kept = orders.where("NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')").withColumn(
        "o_orderstatus", F.when(closing, "F").otherwise(F.col("o_orderstatus"))
    )
    above = orders.agg(F.max("o_orderkey") + 1).scalar()
    reopened = orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").withColumns(
        {"o_orderkey": F.col("o_orderkey") + above, "o_orderstatus": F.lit("O")}
    )
    return kept.unionByName(reopened)


@QUERIES.add("relation_diff", f"""
WITH after AS ({NEXT_SQL})
SELECT 'before' AS side, * FROM (SELECT * FROM orders EXCEPT SELECT * FROM after)
UNION ALL SELECT 'after', * FROM (SELECT * FROM after EXCEPT SELECT * FROM orders)""")
def relation_diff(spark, folder):
    orders = _exact(table(spark, folder, "orders"))
    return as_double(diff.relation_diff(orders, next_orders(orders), "before", "after"), "o_totalprice")


@QUERIES.add("row_diff", f"""
WITH after AS ({NEXT_SQL})
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
       CASE WHEN b.o_orderkey IS NULL THEN 'added' WHEN a.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM orders b FULL JOIN after a ON a.o_orderkey = b.o_orderkey
WHERE (b.o_orderkey, b.o_custkey, b.o_orderstatus, b.o_totalprice, b.o_orderdate, b.o_orderpriority)
   IS DISTINCT FROM (a.o_orderkey, a.o_custkey, a.o_orderstatus, a.o_totalprice, a.o_orderdate, a.o_orderpriority)""")
def row_diff(spark, folder):
    orders = _exact(table(spark, folder, "orders"))
    return diff.row_diff(orders, next_orders(orders), ["o_orderkey"])


@QUERIES.add("row_diff_descended", QUERIES["row_diff"].sql)
def row_diff_descended(spark, folder):
    """The same differences from stored digests: only buckets whose sums differ are read."""
    orders = _exact(table(spark, folder, "orders"))
    before, after = shared_folder(spark, "digests-before"), shared_folder(spark, "digests-after")
    digest_tree.write(orders, ["o_orderkey"], before, digits=1)
    digest_tree.write(next_orders(orders), ["o_orderkey"], after, digits=1)
    return digest_tree.changes(spark, before, after)


def _mismatch_sql() -> str:
    old = "\nUNION ALL ".join(_lanes_sql(f"SELECT md5({_json_sql(t)}) AS d FROM {t}", f"'{t}' AS table_name, ") for t in ("customer", "orders", "events"))
    new = "\nUNION ALL ".join(
        _lanes_sql(f"SELECT md5({_json_sql(t)}) AS d FROM {source}", f"'{t}' AS table_name, ")
        for t, source in (("customer", "customer"), ("orders", f"({NEXT_SQL}) orders"), ("events", "(SELECT * FROM events WHERE event_id % 1000 <> 7) events")))
    return f"""
SELECT e.table_name, e.row_count AS expected_rows, a.row_count AS actual_rows, e.lane_a AS expected_lane, a.lane_a AS actual_lane
FROM ({old}) e JOIN ({new}) a USING (table_name)
WHERE (e.row_count, e.lane_a, e.lane_b) IS DISTINCT FROM (a.row_count, a.lane_a, a.lane_b)"""


@QUERIES.add("fingerprint_mismatch", _mismatch_sql())
def fingerprint_mismatch(spark, folder):
    """Tables whose content changed between two versions, by comparison of stored fingerprints."""
    before = {t: _exact(table(spark, folder, t)) for t in ("customer", "orders", "events")}
    after = {**before, "orders": next_orders(before["orders"]), "events": before["events"].where("event_id % 1000 <> 7")}
    found = fingerprint.mismatches(fingerprint.of_tables(before), fingerprint.of_tables(after))
    return found.select(
        "table_name", F.col("expected.row_count").alias("expected_rows"), F.col("actual.row_count").alias("actual_rows"),
        F.col("expected.lane_a").cast("string").alias("expected_lane"), F.col("actual.lane_a").cast("string").alias("actual_lane"))


_LINES = "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem"
_LINES_AFTER = """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + if(l_partkey % 11 = 3, 1, 0) AS l_quantity, l_shipdate
  FROM lineitem WHERE l_partkey % 13 <> 5"""


def _bags(source: str) -> str:
    listed = "list_sort(list((l_partkey, l_quantity, l_shipdate)))"
    return f"SELECT l_orderkey, l_linenumber, count(*) AS n, {listed} AS bag FROM ({source}) GROUP BY ALL"


@QUERIES.add("row_diff_repeated", f"""
SELECT coalesce(b.l_orderkey, a.l_orderkey) AS l_orderkey, coalesce(b.l_linenumber, a.l_linenumber) AS l_linenumber,
       CASE WHEN b.n IS NULL THEN 'added' WHEN a.n IS NULL THEN 'removed' WHEN greatest(a.n, b.n) > 1 THEN 'repeated' ELSE 'changed' END AS change
FROM ({_bags(_LINES)}) b FULL JOIN ({_bags(_LINES_AFTER)}) a ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
WHERE a.bag IS DISTINCT FROM b.bag""")
def row_diff_repeated(spark, folder):
    """Differences by a key that many lines share."""
    lines = _exact(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"))
    more = F.when(F.col("l_partkey") % 11 == 3, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    after = lines.where("l_partkey % 13 <> 5").withColumn("l_quantity", more.cast(lines.schema["l_quantity"].dataType))
    return diff.row_diff(lines, after, ["l_orderkey", "l_linenumber"])
