"""The region, nation, customer tree as an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.contract import verify
from cartloom.contract.model import Check, Column, Contract, Table
from cartloom.operators import hierarchy
from cartloom.operators.profiling import union_all
from cartloom.operators.skew import broadcast_if_small
from cartloom.plans.registry import Registry
from cartloom.plans.star import as_double, dec, table

QUERIES = Registry()

NODES_SQL = """
  SELECT 'R' || r_regionkey AS id, NULL AS parent_id, r_name AS name FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, c_name FROM customer"""


def _key(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def nodes(spark, folder) -> DataFrame:
    return union_all([
        table(spark, folder, "region").select(
            _key("R", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("name")
        ),
        table(spark, folder, "nation").select(
            _key("N", "n_nationkey").alias("id"), _key("R", "n_regionkey").alias("parent_id"), F.col("n_name").alias("name")
        ),
        table(spark, folder, "customer").select(
            _key("C", "c_custkey").alias("id"), _key("N", "c_nationkey").alias("parent_id"), F.col("c_name").alias("name")
        ),
    ])


def cyclic_edges(spark, folder) -> DataFrame:
    """The tree with an edge from each region that starts with A to its lowest nation, which closes a loop."""
    lowest = table(spark, folder, "nation").groupBy(_key("R", "n_regionkey").alias("id")).agg(
        F.min("n_nationkey").alias("n_nationkey")
    ).select("id", _key("N", "n_nationkey").alias("loop_to"))
    looping = F.col("parent_id").isNull() & F.col("name").startswith("A")
    return nodes(spark, folder).join(broadcast_if_small(lowest), "id", "left").select(
        "id", F.when(looping, F.col("loop_to")).otherwise(F.col("parent_id")).alias("parent_id")
    )


# Walk from every node to its ancestors with the path so far, and stop where a node repeats.
_WALK = """
walk AS (
  SELECT id AS start, parent_id, [id] AS path, false AS looped FROM edges
  UNION ALL
  SELECT w.start, e.parent_id, list_append(w.path, e.id), list_contains(w.path, e.id)
  FROM walk w JOIN edges e ON e.id = w.parent_id WHERE NOT w.looped)"""


@QUERIES.add("hierarchy_depth", f"""
WITH RECURSIVE edges AS (SELECT id, parent_id FROM ({NODES_SQL})), {_WALK}
SELECT start AS id, max(len(path)) AS depth FROM walk GROUP BY start""")
def hierarchy_depth(spark, folder):
    return hierarchy.depths(nodes(spark, folder).select("id", "parent_id")).select("id", "depth")


@QUERIES.add("hierarchy_cycle", f"""
WITH RECURSIVE edges AS (
  SELECT id, if(parent_id IS NULL AND name LIKE 'A%',
                (SELECT 'N' || min(n_nationkey) FROM nation WHERE 'R' || n_regionkey = t.id), parent_id) AS parent_id
  FROM ({NODES_SQL}) t), {_WALK}
SELECT start AS id, bool_or(looped) AS cyclic FROM walk GROUP BY start""")
def hierarchy_cycle(spark, folder):
    return hierarchy.depths(cyclic_edges(spark, folder)).select("id", "cyclic")


@QUERIES.add("hierarchy_paths", f"""
WITH RECURSIVE edges AS (
  SELECT id, if(parent_id IS NULL AND name LIKE 'A%',
                (SELECT 'N' || min(n_nationkey) FROM nation WHERE 'R' || n_regionkey = t.id), parent_id) AS parent_id
  FROM ({NODES_SQL}) t), {_WALK},
whole AS (SELECT start AS id, arg_max(path, len(path)) AS path, bool_or(looped) AS looped FROM walk GROUP BY start),
loops AS (SELECT id, path, path[list_position(path, path[-1]) : len(path) - 1] AS members FROM whole WHERE looped),
rings AS (SELECT id AS leader, [id] || list_reverse(path[2 : len(path) - 1]) AS cycle FROM loops WHERE id = list_min(members)),
placed AS (
  SELECT w.id, CASE WHEN NOT looped THEN list_reverse(w.path) WHEN list_contains(cycle, w.id) THEN cycle[1 : list_position(cycle, w.id)] END AS path, cycle
  FROM whole w LEFT JOIN loops l ON l.id = w.id LEFT JOIN rings r ON r.leader = list_min(l.members))
SELECT id, array_to_string(path, '>') AS path, coalesce(len(path), 0)::INTEGER AS position, array_to_string(cycle, '>') AS cycle FROM placed""")
def hierarchy_paths(spark, folder):
    """The path of every node of the tree with loops, its place, and the members of the loop that it meets."""
    found = hierarchy.paths(cyclic_edges(spark, folder))
    return found.select("id", F.array_join("path", ">").alias("path"), F.coalesce("position", F.lit(0)).alias("position"), F.array_join("cycle", ">").alias("cycle"))


@QUERIES.add("hierarchy_children", f"""
WITH t AS ({NODES_SQL})
SELECT p.id AS parent_id, p.name AS parent_name, c.id, c.name FROM t c JOIN t p ON p.id = c.parent_id""")
def hierarchy_children(spark, folder):
    return hierarchy.children(nodes(spark, folder))


@QUERIES.add("hierarchy_rollup", f"""
WITH RECURSIVE edges AS (SELECT id, parent_id FROM ({NODES_SQL})), {_WALK}
SELECT path[-1] AS id, sum(n)::BIGINT AS customers, sum(cents)::BIGINT::DOUBLE / 100 AS balance
FROM walk JOIN (SELECT 'C' || c_custkey AS leaf, 1 AS n, round(c_acctbal * 100)::BIGINT AS cents FROM customer) ON leaf = start
GROUP BY path[-1]""")
def hierarchy_rollup(spark, folder):
    """Customers and balances summed into every node above them."""
    measures = table(spark, folder, "customer").select(
        _key("C", "c_custkey").alias("id"), F.lit(1).cast("bigint").alias("one"), dec("c_acctbal").alias("amount")
    )
    rolled = hierarchy.rollup(
        nodes(spark, folder).select("id", "parent_id"), measures, {"customers": "one", "balance": "amount"}
    )
    return as_double(rolled, "balance")


# -- edges that a row rule forbids ---------------------------------------------------------------------------------

EDGES = Contract((
    Table("edges", (Column("id", "string"), Column("parent_id", "string", nullable=True)),
          checks=(Check("not_own_parent", "parent_id <> id"),)),
))


@QUERIES.add("own_parents", f"""
SELECT 'check' AS "check", 'edges.not_own_parent' AS subject, '= 0' AS expected, count(*) FILTER (WHERE p = id) AS observed,
       count(*) FILTER (WHERE p = id) = 0 AS passed
FROM (SELECT id, if(name LIKE 'A%', id, parent_id) AS p FROM ({NODES_SQL}))""")
def own_parents(spark, folder):
    """The row rule on a copy of the tree in which nodes whose name starts with A are their own parents; a root breaks nothing."""
    looped = F.when(F.col("name").startswith("A"), F.col("id")).otherwise(F.col("parent_id")).alias("parent_id")
    return verify.scan_rules(EDGES, {"edges": nodes(spark, folder).select("id", looped)}, ("check",))
