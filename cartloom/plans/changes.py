"""Change sets against the given orders and customers, with rejected rows by class."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.contract import verify
from cartloom.contract.model import Check, Column, Contract, Reference, Table
from cartloom.operators import mutate
from cartloom.plans.registry import Registry
from cartloom.plans.star import STAR, table
from cartloom.session import shared_folder
from cartloom.sources import bucketed, csv_lines, snapshot

QUERIES = Registry()

ORDERS = Table(
    "orders",
    STAR["orders"].columns,
    primary_key=("o_orderkey",),
    references=(Reference("o_custkey", "customer", "c_custkey"),),
    checks=(Check.one_of("o_orderstatus", ["O", "F", "P"]), Check.finite_amount("o_totalprice")),
)
CUSTOMERS = Table(
    "customer",
    (Column("c_custkey", "bigint"), Column("c_name", "string"), Column("c_nationkey", "int"),
     Column("c_acctbal", "double"), Column("c_mktsegment", "string")),
    primary_key=("c_custkey",),
)

# Every order brings one change. Its priority decides what kind:
#   1 a new order under a free key     2 an insert under a key that exists    3 a valid status update
#   4 an update to a missing customer  5 an update to a negative price and an unknown status
CHANGES_SQL = f"""
  SELECT if(o_orderpriority LIKE '1%', o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders), o_orderkey) AS o_orderkey,
         if(o_orderpriority LIKE '4%', -1, o_custkey) AS o_custkey,
         CASE left(o_orderpriority, 1) WHEN '3' THEN 'F' WHEN '5' THEN '?' ELSE o_orderstatus END AS o_orderstatus,
         if(o_orderpriority LIKE '5%', -1, o_totalprice) AS o_totalprice, o_orderdate, o_orderpriority FROM orders"""
REJECTED_SQL = f"""
  SELECT o_orderkey, 'unique' AS violation, 'o_orderkey' AS rule FROM ({CHANGES_SQL}) WHERE o_orderpriority LIKE '2%'
  UNION ALL SELECT o_orderkey, 'foreign_key', 'o_custkey' FROM ({CHANGES_SQL}) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT o_orderkey, 'check', 'o_orderstatus.one_of' FROM ({CHANGES_SQL}) WHERE o_orderstatus NOT IN ('O', 'F', 'P')
  UNION ALL SELECT o_orderkey, 'check', 'o_totalprice.finite_amount' FROM ({CHANGES_SQL}) WHERE o_totalprice < 0"""


def order_changes(orders: DataFrame) -> DataFrame:
    kind = F.substring("o_orderpriority", 1, 1)
    above = orders.agg(F.max("o_orderkey") + 1).scalar()
    status = F.when(kind == "3", "F").when(kind == "5", "?").otherwise(F.col("o_orderstatus"))
    return orders.select(
        F.when(kind == "1", F.col("o_orderkey") + above).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        F.when(kind == "4", F.lit(-1).cast("bigint")).otherwise(F.col("o_custkey")).alias("o_custkey"),
        status.alias("o_orderstatus"),
        F.when(kind == "5", F.lit(-1.0)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
        F.when(kind.isin("1", "2"), mutate.INSERT).otherwise(mutate.UPDATE).alias("op"),
    )


def _outcome(spark, folder) -> mutate.Outcome:
    orders = table(spark, folder, "orders")
    return mutate.upsert(order_changes(orders), ORDERS, orders, {"customer": table(spark, folder, "customer")})


@QUERIES.add("upsert_apply", f"""
WITH changes AS ({CHANGES_SQL}), rejected AS ({REJECTED_SQL}),
accepted AS (SELECT * FROM changes WHERE o_orderkey NOT IN (SELECT o_orderkey FROM rejected))
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM accepted) UNION ALL SELECT * FROM accepted""")
def upsert_apply(spark, folder):
    return _outcome(spark, folder).table


@QUERIES.add("reject_classes", REJECTED_SQL)
def reject_classes(spark, folder):
    return _outcome(spark, folder).rejected


@QUERIES.add("upsert_bucketed", QUERIES["upsert_apply"].sql)
def upsert_bucketed(spark, folder):
    """The same change set against tables in buckets by their primary keys: however large the set, only its keys move."""
    orders = bucketed.write(table(spark, folder, "orders"), shared_folder(spark, "orders"), ["o_orderkey"])
    customers = bucketed.write(table(spark, folder, "customer"), shared_folder(spark, "customer"), ["c_custkey"])
    sizes = {"orders": orders.buckets, "customer": customers.buckets}
    changes = order_changes(table(spark, folder, "orders"))
    return mutate.upsert(changes, ORDERS, orders.rows, {"customer": customers.rows}, sizes, broadcast_rows=0).table


@QUERIES.add("update_where", """
SELECT * REPLACE (if(o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01', 'F', o_orderstatus) AS o_orderstatus,
                  if(o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01', o_orderdate + INTERVAL 5 MINUTE, o_orderdate) AS o_orderdate)
FROM orders""")
def update_where(spark, folder):
    stale = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.expr("timestamp_ntz'1998-01-01 00:00:00'"))
    return mutate.update_where(
        table(spark, folder, "orders"), stale,
        {"o_orderstatus": F.lit("F"), "o_orderdate": F.col("o_orderdate") + F.expr("interval 5 minutes")},
    )


@QUERIES.add("update_from", """
SELECT o.* REPLACE (coalesce(l.last_ship, o.o_orderdate) AS o_orderdate)
FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) l ON l_orderkey = o_orderkey""")
def update_from(spark, folder):
    """Every order with lines takes the date of its last shipment."""
    last = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("o_orderdate")
    )
    return mutate.update_from(table(spark, folder, "orders"), last, "o_orderkey", ["o_orderdate"])


_DOOMED = "c_acctbal < 1000"


def _delete(spark, folder) -> mutate.Outcome:
    events = table(spark, folder, "events")
    return mutate.delete(
        table(spark, folder, "customer"), F.expr(_DOOMED), CUSTOMERS, {"events.user_id": (events, "user_id")}
    )


@QUERIES.add("delete_apply", f"""
SELECT * FROM customer WHERE NOT ({_DOOMED}) OR c_custkey IN (SELECT user_id FROM events)""")
def delete_apply(spark, folder):
    return _delete(spark, folder).table


@QUERIES.add("delete_rejected", f"""
SELECT c_custkey, 'foreign_key' AS violation, 'events.user_id' AS rule FROM customer
WHERE {_DOOMED} AND c_custkey IN (SELECT user_id FROM events)""")
def delete_rejected(spark, folder):
    return _delete(spark, folder).rejected


# -- sets over two tables whose rows depend on each other ----------------------------------------------------------

PAIR = Contract((
    replace(CUSTOMERS, checks=(Check.finite_amount("c_acctbal"),)),
    ORDERS,
))

# Every third customer brings a new one, every second of these with a bad balance; every order brings a new order of the
# customer that its own customer would have brought, so many of them have no parent, or a rejected one.
NEW_CUSTOMERS_SQL = """
  SELECT c_custkey + (SELECT max(c_custkey) + 1 FROM customer) AS c_custkey, c_name || '+' AS c_name, c_nationkey,
         if(c_custkey % 2 = 1, -1, c_acctbal) AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 = 0"""
NEW_ORDERS_SQL = """
  SELECT o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders) AS o_orderkey, o_custkey + (SELECT max(c_custkey) + 1 FROM customer) AS o_custkey,
         o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"""
_GOOD_SQL = f"SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM ({NEW_CUSTOMERS_SQL}) WHERE c_acctbal >= 0"


def _batch(spark, folder) -> dict[str, mutate.Outcome]:
    customers = table(spark, folder, "customer").select(*PAIR["customer"].schema.names)
    orders = table(spark, folder, "orders")
    above = customers.agg(F.max("c_custkey") + 1).scalar()
    new_customers = customers.where("c_custkey % 3 = 0").select(
        (F.col("c_custkey") + above).alias("c_custkey"), F.concat("c_name", F.lit("+")).alias("c_name"), "c_nationkey",
        F.when(F.col("c_custkey") % 2 == 1, F.lit(-1.0)).otherwise(F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment",
        F.lit(mutate.INSERT).alias("op"))
    new_orders = orders.select(
        (F.col("o_orderkey") + orders.agg(F.max("o_orderkey") + 1).scalar()).alias("o_orderkey"),
        (F.col("o_custkey") + above).alias("o_custkey"), "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
        F.lit(mutate.INSERT).alias("op"))
    return mutate.batch({"customer": new_customers, "orders": new_orders}, PAIR, {"customer": customers, "orders": orders})


@QUERIES.add("batch_apply", f"""
SELECT * FROM orders UNION ALL SELECT * FROM ({NEW_ORDERS_SQL}) WHERE o_custkey IN ({_GOOD_SQL})""")
def batch_apply(spark, folder):
    """Orders after a batch that inserts customers and their orders together."""
    return _batch(spark, folder)["orders"].table


@QUERIES.add("batch_rejected", f"""
SELECT 'orders' AS table_name, o_orderkey AS id, 'foreign_key' AS violation, 'o_custkey' AS rule FROM ({NEW_ORDERS_SQL}) WHERE o_custkey NOT IN ({_GOOD_SQL})
UNION ALL SELECT 'customer', c_custkey, 'check', 'c_acctbal.finite_amount' FROM ({NEW_CUSTOMERS_SQL}) WHERE c_acctbal < 0""")
def batch_rejected(spark, folder):
    """Rejected rows of the batch; the orders of a rejected customer are rejected with it."""
    found = _batch(spark, folder)
    return found["orders"].rejected.select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("id"), "violation", "rule").union(
        found["customer"].rejected.select(F.lit("customer"), F.col("c_custkey"), "violation", "rule"))


@QUERIES.add("delete_tree", """
SELECT c_custkey, c_custkey % 5 = 0 AS kept_by_an_order FROM customer
WHERE c_custkey % 5 <> 0 OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_custkey % 10 <> 0)""")
def delete_tree(spark, folder):
    """Customers left after deleting every fifth of them together with the orders of every tenth."""
    customers, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    doomed = {"customer": customers.where("c_custkey % 5 = 0"), "orders": orders.where("o_custkey % 10 = 0")}
    left = mutate.delete_batch({name: df.select(*PAIR[name].primary_key) for name, df in doomed.items()}, PAIR,
                               {"customer": customers, "orders": orders})["customer"].table
    return left.select("c_custkey", (F.col("c_custkey") % 5 == 0).alias("kept_by_an_order"))


# -- a file with damaged lines -------------------------------------------------------------------------------------

# Some lines lose a field, some have one too many, some a nation or a balance that is no number.
_LINES_SQL = """
  SELECT c_custkey, concat_ws(',', c_custkey::VARCHAR, c_name,
         if(c_custkey % 89 = 5, 'x' || c_nationkey, c_nationkey::VARCHAR),
         if(c_custkey % 31 = 7, '-', round(c_acctbal * 100)::BIGINT::VARCHAR),
         if(c_custkey % 97 = 3, NULL, c_mktsegment), if(c_custkey % 83 = 7, 'more', NULL)) AS text FROM customer"""
CSV_CUSTOMERS = "c_custkey bigint, c_name string, c_nationkey int, cents bigint, c_mktsegment string"


def _customer_file(spark, folder) -> csv_lines.Parsed:
    """The customers as lines of text in the shared folder, some of them damaged, read again."""
    key = F.col("c_custkey")
    fields = [
        key.cast("string"), F.col("c_name"), F.when(key % 89 == 5, F.concat(F.lit("x"), F.col("c_nationkey"))).otherwise(F.col("c_nationkey").cast("string")),
        F.when(key % 31 == 7, "-").otherwise(F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")),
        F.when(key % 97 != 3, F.col("c_mktsegment")), F.when(key % 83 == 7, "more"),
    ]
    path = shared_folder(spark, "customer-lines")
    table(spark, folder, "customer").select(F.concat_ws(",", *fields).alias("value")).write.text(path)
    schema = spark.createDataFrame([], CSV_CUSTOMERS).schema
    return csv_lines.read(spark, path, schema, header=False)


@QUERIES.add("csv_rejects", f"""
SELECT text, CASE WHEN (c_custkey % 97 = 3) <> (c_custkey % 83 = 7) THEN 'fields'
       ELSE 'type:' || concat_ws(',', if(c_custkey % 89 = 5, 'c_nationkey', NULL), if(c_custkey % 31 = 7, 'cents', NULL)) END AS reason
FROM ({_LINES_SQL})
WHERE (c_custkey % 97 = 3) <> (c_custkey % 83 = 7) OR c_custkey % 89 = 5 OR c_custkey % 31 = 7""")
def csv_rejects(spark, folder):
    """Lines that don't parse, with the reason."""
    return _customer_file(spark, folder).rejected.select("text", "reason")


@QUERIES.add("csv_rows", """
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal * 100)::BIGINT AS cents, if(c_custkey % 97 = 3, 'more', c_mktsegment) AS c_mktsegment FROM customer
WHERE (c_custkey % 97 = 3) = (c_custkey % 83 = 7) AND c_custkey % 89 <> 5 AND c_custkey % 31 <> 7""")
def csv_rows(spark, folder):
    """The rows of the other lines."""
    return _customer_file(spark, folder).rows


# -- versions that are published, restored and swept ---------------------------------------------------------------

_FINISHED = "o_orderstatus = 'F'"


@QUERIES.add("publish_round_trip", f"""
SELECT 'published' AS step, * FROM orders UNION ALL SELECT 'restored', * FROM orders WHERE {_FINISHED}""")
def publish_round_trip(spark, folder):
    """Rows as readers load them after a second publication, and after the first one is restored; a third build dies and is swept."""
    orders, root = table(spark, folder, "orders"), shared_folder(spark, "publications")
    contract = Contract((replace(ORDERS, references=(), checks=(Check.finite_amount("o_totalprice"),)),))

    def verifier(tables):
        return verify.structural(spark, contract, tables)

    path = {"orders": ["o_custkey", "o_orderdate", "o_orderkey"]}
    first = snapshot.publish(spark, {"orders": orders.where(_FINISHED)}, root, verifier, "finished", path)
    snapshot.publish(spark, {"orders": orders}, root, verifier, "all", path)
    snapshot.stage(spark, {"orders": orders}, root, path, lease_seconds=0.0)
    snapshot.sweep(spark, root)
    published = snapshot.load(spark, root)["orders"]
    snapshot.restore(spark, root, first, verifier)
    restored = snapshot.load(spark, root)["orders"]
    return published.select(F.lit("published").alias("step"), "*").union(restored.select(F.lit("restored"), "*"))
