"""Commerce questions over the given tables: totals, attempts, histories, ledgers, pages and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.operators import commerce, ordered
from cartloom.plans.registry import Registry
from cartloom.plans.star import as_double, dec, table
from cartloom.session import shared_folder
from cartloom.sources import snapshot

QUERIES = Registry()

LEDGER_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"]


def _attempts(spark, folder) -> DataFrame:
    """Events as attempts of a (user, day)."""
    return table(spark, folder, "events").select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts", "event_type")


def _attempt_profile(spark, folder) -> DataFrame:
    failed, succeeded = F.col("event_type") == "error", F.col("event_type") == "purchase"
    return commerce.attempt_profile(_attempts(spark, folder), ["user_id", "day"], failed, succeeded, "ts")


# -- money -------------------------------------------------------------------------------------------------


@QUERIES.add("order_totals", """
SELECT l_orderkey, sum(round(l_extendedprice * 100)::BIGINT * (100 - round(l_discount * 100)::BIGINT))::BIGINT::DOUBLE / 10000 AS total
FROM lineitem GROUP BY l_orderkey""")
def order_totals(spark, folder):
    """Order totals from the historical line prices, discount included."""
    amount = dec("l_extendedprice") * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)"))
    totals = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.sum(amount).alias("total"))
    return as_double(totals, "total")


@QUERIES.add("product_sales", """
SELECT p_partkey, count(l_partkey) AS lines, coalesce(sum(l_quantity::BIGINT), 0)::BIGINT AS units,
       coalesce(sum(round(l_extendedprice * 100)::BIGINT), 0)::BIGINT::DOUBLE / 100 AS revenue
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey""")
def product_sales(spark, folder):
    sales = commerce.child_sales(
        table(spark, folder, "part").select("p_partkey"), "p_partkey", table(spark, folder, "lineitem"), "l_partkey",
        F.col("l_quantity").cast("bigint"), dec("l_extendedprice"),
    )
    return as_double(sales, "revenue")


@QUERIES.add("collected_revenue", """
SELECT user_id, sum(cents) FILTER (WHERE status IN ('SUCCEEDED', 'REFUNDED'))::BIGINT::DOUBLE / 100 AS gross,
       coalesce(sum(cents) FILTER (WHERE status = 'REFUNDED'), 0)::BIGINT::DOUBLE / 100 AS refunded,
       coalesce(sum(cents) FILTER (WHERE status = 'SUCCEEDED'), 0)::BIGINT::DOUBLE / 100 AS net
FROM (SELECT user_id, round(value * 100)::BIGINT AS cents,
             CASE event_type WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'click' THEN 'REFUNDED' WHEN 'error' THEN 'FAILED'
                             ELSE 'PENDING' END AS status FROM events) GROUP BY user_id""")
def collected_revenue(spark, folder):
    """Receipts per user: purchases are received, clicks stand for refunded attempts, errors for failed ones."""
    status = F.col("event_type")
    payments = table(spark, folder, "events").select(
        "user_id",
        dec("value").alias("amount"),
        F.when(status == "purchase", "SUCCEEDED").when(status == "click", "REFUNDED").when(status == "error", "FAILED")
        .otherwise("PENDING").alias("status"),
    )
    return as_double(commerce.receipts(payments, "status", "amount", ["user_id"]), "gross", "refunded", "net")


# -- attempts and histories --------------------------------------------------------------------------------

_BY_DAY = "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, ts, event_id, event_type FROM events"


@QUERIES.add("attempts_per_order", f"SELECT user_id, day, count(*) AS attempts FROM ({_BY_DAY}) GROUP BY ALL")
def attempts_per_order(spark, folder):
    return _attempts(spark, folder).groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("attempts"))


@QUERIES.add("failed_only", f"""
SELECT user_id, day, count(*) AS attempts FROM ({_BY_DAY}) GROUP BY user_id, day HAVING bool_and(event_type = 'error')""")
def failed_only(spark, folder):
    return _attempt_profile(spark, folder).where("failed_only").select("user_id", "day", "attempts")


@QUERIES.add("success_after_failure", f"""
WITH a AS ({_BY_DAY})
SELECT DISTINCT f.user_id, f.day FROM a f JOIN a s USING (user_id, day)
WHERE f.event_type = 'error' AND s.event_type = 'purchase' AND f.ts < s.ts""")
def success_after_failure(spark, folder):
    return _attempt_profile(spark, folder).where("success_after_failure").select("user_id", "day")


_NEXT_SQL = """
WITH f AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'error'),
s AS (SELECT user_id, ts AS next_ts, min(event_id) AS next_event_id, arg_min(value, event_id) AS next_value
      FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts)
SELECT f.event_id, f.user_id, f.ts, f.value, next_event_id, next_ts, next_value FROM f ASOF JOIN s ON f.user_id = s.user_id AND f.ts < s.next_ts"""


def _recovered(spark, folder, **options) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value", "event_type")
    failed, succeeded = (events.where(F.col("event_type") == kind).drop("event_type") for kind in ("error", "purchase"))
    return ordered.next_match(failed, succeeded, ["user_id"], "ts", "event_id", **options).where("next_event_id IS NOT NULL")


@QUERIES.add("first_success_after_failure", _NEXT_SQL)
def first_success_after_failure(spark, folder):
    """Every failure with the first success of its user that follows it, with the columns of both."""
    return _recovered(spark, folder)


@QUERIES.add("first_success_after_failure_cut", _NEXT_SQL)
def first_success_after_failure_cut(spark, folder):
    return _recovered(spark, folder, task_rows=CUT_ROWS)


@QUERIES.add("attempt_sequence", f"""
SELECT event_id, user_id, day, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS attempt FROM ({_BY_DAY})""")
def attempt_sequence(spark, folder):
    numbered = commerce.attempt_sequence(_attempts(spark, folder), ["user_id", "day"], ["ts", "event_id"])
    return numbered.select("event_id", "user_id", "day", "attempt")


@QUERIES.add("previous_event", """
SELECT event_id, user_id, ts, lag(ts) OVER w AS previous_at, lag(event_type) OVER w AS previous_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def previous_event(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    return ordered.scan(
        events, ["user_id"], ["ts", "event_id"], previous={"previous_at": "ts", "previous_type": "event_type"}
    ).drop("event_type")


# The same answers with keys cut at few rows, as large tables have them cut.
CUT_ROWS = 2_000


@QUERIES.add("previous_event_cut", QUERIES["previous_event"].sql)
def previous_event_cut(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    return ordered.scan(
        events, ["user_id"], ["ts", "event_id"], previous={"previous_at": "ts", "previous_type": "event_type"}, task_rows=CUT_ROWS
    ).drop("event_type")


@QUERIES.add("first_event", """
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def first_event(spark, folder):
    columns = {c: c for c in ("event_id", "ts", "event_type")}
    return ordered.ends(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], first=columns)


@QUERIES.add("latest_event", """
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_event(spark, folder):
    columns = {c: c for c in ("event_id", "ts", "event_type")}
    return ordered.ends(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], last=columns)


@QUERIES.add("optional_child", """
SELECT o_orderkey, o_custkey, lines, first_ship
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey)
  ON l_orderkey = o_orderkey""")
def optional_child(spark, folder):
    """Every order with its shipment facts; NULL where nothing was shipped."""
    shipped = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.min("l_shipdate").alias("first_ship")
    )
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey").join(shipped, "o_orderkey", "left")


# -- ledger ------------------------------------------------------------------------------------------------


def _ledger(spark, folder) -> DataFrame:
    delta = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(-F.col("l_quantity")).cast("bigint")
    return table(spark, folder, "lineitem").select("l_partkey", *LEDGER_ORDER, delta.alias("delta"))


@QUERIES.add("ledger_facts", """
SELECT l_partkey, count(*) AS movements, sum(if(l_returnflag = 'R', l_quantity, -l_quantity)::BIGINT)::BIGINT AS net,
       bool_or(l_returnflag = 'R') AND bool_or(l_returnflag <> 'R') AS both_signs FROM lineitem GROUP BY l_partkey""")
def ledger_facts(spark, folder):
    return _ledger(spark, folder).groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("movements"),
        F.sum("delta").alias("net"),
        (F.bool_or(F.col("delta") > 0) & F.bool_or(F.col("delta") < 0)).alias("both_signs"),
    )


@QUERIES.add("running_balance", f"""
SELECT l_partkey, {', '.join(LEDGER_ORDER)}, delta,
       sum(delta) OVER (PARTITION BY l_partkey ORDER BY {', '.join(LEDGER_ORDER)} ROWS UNBOUNDED PRECEDING)::BIGINT AS balance
FROM (SELECT *, if(l_returnflag = 'R', l_quantity, -l_quantity)::BIGINT AS delta FROM lineitem)""")
def running_balance(spark, folder):
    return commerce.running_balance(_ledger(spark, folder), "l_partkey", LEDGER_ORDER, "delta")


@QUERIES.add("running_balance_cut", f"""
SELECT 0 AS part, {', '.join(LEDGER_ORDER)}, delta,
       sum(delta) OVER (ORDER BY {', '.join(LEDGER_ORDER)}, l_partkey ROWS UNBOUNDED PRECEDING)::BIGINT AS balance
FROM (SELECT *, if(l_returnflag = 'R', l_quantity, -l_quantity)::BIGINT AS delta FROM lineitem)""")
def running_balance_cut(spark, folder):
    """One ledger of all parts together: a single key that is cut many times."""
    ledger = _ledger(spark, folder).withColumn("part", F.lit(0))
    balance = commerce.running_balance(ledger, "part", [*LEDGER_ORDER, "l_partkey"], "delta", task_rows=CUT_ROWS)
    return balance.select("part", *LEDGER_ORDER, "delta", "balance")


# -- pages, lookups and filters ----------------------------------------------------------------------------


@QUERIES.add("keyset_page", """
SELECT o_orderdate, o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-06-15', 700) ORDER BY o_orderdate, o_orderkey LIMIT 50""")
def keyset_page(spark, folder):
    """The page of 50 orders after a (date, key) cursor."""
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_custkey", "o_orderstatus")
    cursor = [F.expr("timestamp_ntz'1998-06-15 00:00:00'"), F.lit(700).cast("bigint")]
    return commerce.keyset_page(orders, ["o_orderdate", "o_orderkey"], 50, cursor)


@QUERIES.add("customer_order_page", """
SELECT o_orderdate, o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_custkey = 7 AND (o_orderdate, o_orderkey) > (TIMESTAMP '1996-01-01', 0) ORDER BY o_orderdate, o_orderkey LIMIT 5""")
def customer_order_page(spark, folder):
    """One customer's next five orders by date; the customer filter reaches the file scan."""
    orders = table(spark, folder, "orders").where("o_custkey = 7").select(
        "o_orderdate", "o_orderkey", "o_custkey", "o_orderstatus"
    )
    cursor = [F.expr("timestamp_ntz'1996-01-01 00:00:00'"), F.lit(0).cast("bigint")]
    return commerce.keyset_page(orders, ["o_orderdate", "o_orderkey"], 5, cursor)


@QUERIES.add("exact_lookup", "SELECT * FROM customer WHERE c_name = 'Customer#000000042'")
def exact_lookup(spark, folder):
    return table(spark, folder, "customer").where("c_name = 'Customer#000000042'")


@QUERIES.add("stored_lookup", """
SELECT event_id, user_id, ts, event_type FROM events WHERE event_id IN (7, 42, (SELECT max(event_id) FROM events), -1)""")
def stored_lookup(spark, folder):
    """Events by id in a snapshot that is clustered by user: Bloom filters of the ids skip row groups."""
    events, root = table(spark, folder, "events"), shared_folder(spark, "events-snapshot")
    last = events.agg(F.max("event_id")).first()[0]
    version = snapshot.stage(spark, {"events": events}, root, {"events": ["user_id", "ts", "event_id"]}, lookups={"events": ["event_id"]})
    wanted = [key for key in (7, 42, last, -1) if key is not None]
    stored = snapshot.open_version(spark, root, version)["events"]
    return stored.where(F.col("event_id").isin(wanted)).select("event_id", "user_id", "ts", "event_type")


@QUERIES.add("range_filter", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'""")
def range_filter(spark, folder):
    """Orders of a status and a half-open date range."""
    return table(spark, folder, "orders").where(
        "o_orderdate >= timestamp_ntz'1997-01-01' AND o_orderdate < timestamp_ntz'1998-01-01' AND o_orderstatus = 'F'"
    ).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


@QUERIES.add("attribute_filter", """
SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('purchase', 'error') AND value BETWEEN 10 AND 60""")
def attribute_filter(spark, folder):
    """Attempts of given kinds within an amount range."""
    return table(spark, folder, "events").where("event_type IN ('purchase', 'error') AND value BETWEEN 10 AND 60").select(
        "event_id", "user_id", "event_type", "value"
    )


@QUERIES.add("name_search", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def name_search(spark, folder):
    return table(spark, folder, "part").where(F.contains("p_name", F.lit("ring"))).select("p_partkey", "p_name")


@QUERIES.add("products_by_category", "SELECT p_type, p_partkey, p_name, p_retailprice FROM part WHERE p_type = 'ECONOMY'")
def products_by_category(spark, folder):
    return table(spark, folder, "part").where("p_type = 'ECONOMY'").select("p_type", "p_partkey", "p_name", "p_retailprice")
