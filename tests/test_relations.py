import random

import pytest
from pyspark.sql import functions as F

from cartloom.operators import commerce, diff, hierarchy, keys, profiling, skew


def edge_frame(spark, edges):
    return spark.createDataFrame(list(edges.items()), "id bigint, parent_id bigint")


def brute_depths(edges):
    """Depth by walking up, None where the walk repeats a node."""
    result = {}
    for node in edges:
        seen, at = [node], edges[node]
        while at is not None and at in edges and at not in seen:
            seen.append(at)
            at = edges[at]
        result[node] = None if at in seen else len(seen)
    return result


@pytest.mark.parametrize("seed", range(4))
def test_depths_and_cycles_equal_walks(spark, seed):
    rng = random.Random(seed)
    edges = {0: None}
    for node in range(1, 150):
        edges[node] = rng.choice([None, node - 1, node - 1, rng.randrange(node), 9999 if seed == 2 else 0])
    if seed:
        edges[5], edges[6] = 6, 5
        edges[20] = 40
    rows = hierarchy.depths(edge_frame(spark, edges)).collect()
    assert {r.id: r.depth for r in rows} == brute_depths(edges)
    assert all(r.cyclic == (r.depth is None) for r in rows)


def test_long_chain_and_self_loop(spark):
    chain = edge_frame(spark, {i: i - 1 if i else None for i in range(300)})
    assert hierarchy.summary(chain).first().asDict() == {"nodes": 300, "max_depth": 300, "cyclic_nodes": 0}
    looped = edge_frame(spark, {1: 1, 2: 1, 3: None})
    assert {r.id for r in hierarchy.depths(looped).where("cyclic").collect()} == {1, 2}


def test_rollup_sums_every_descendant(spark):
    edges = edge_frame(spark, {1: None, 2: 1, 3: 1, 4: 2, 5: 2})
    measures = spark.createDataFrame([(4, 10), (4, 1), (5, 5), (3, 7), (2, 100)], "id bigint, v int")
    rolled = {r.id: r.total for r in hierarchy.rollup(edges, measures, {"total": "v"}).collect()}
    assert rolled == {1: 123, 2: 116, 3: 7, 4: 11, 5: 5}


def test_rollup_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n, cuts = 1000, []
    real = hierarchy.cut_lineage
    monkeypatch.setattr(hierarchy, "cut_lineage", lambda df: cuts.append(1) or real(df))
    chain = edge_frame(spark, {i: i - 1 if i else None for i in range(n)})
    measures = spark.range(n).select("id", F.lit(1).alias("v"))
    rolled = {r.id: r.total for r in hierarchy.rollup(chain, measures, {"total": "v"}).collect()}
    assert rolled == {i: n - i for i in range(n)} and len(cuts) < 45


def test_rollup_of_a_random_forest(spark):
    rng = random.Random(8)
    edges = {i: rng.choice([None, i - 1, rng.randrange(i), 5000 + i % 3]) if i else None for i in range(200)}
    values = [(rng.choice([*range(200), 7777]), rng.randrange(9)) for _ in range(300)]
    want = {}
    for node, v in values:
        while node is not None:
            want[node] = want.get(node, 0) + v
            node = edges.get(node)
    measures = spark.createDataFrame(values, "id bigint, v int")
    assert {r.id: r.total for r in hierarchy.rollup(edge_frame(spark, edges), measures, {"total": "v"}).collect()} == want


def test_rollup_refuses_a_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "id bigint, parent_id bigint")
    measures = spark.createDataFrame([(3, 5)], "id bigint, v int")
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.rollup(edges, measures, {"total": "v"})


def test_lookup_with_hot_keys(spark):
    many = spark.range(30_000).select(F.expr("if(id % 3 = 0, 7, id % 500)").alias("k"), F.col("id").alias("row"))
    one = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hot = skew.hot_keys(many, ["k"], task_rows=1_000)
    assert [r.k for r in hot.collect()] == [7] and hot.first().parts >= 9
    for how in ("inner", "left"):
        plain = many.join(one, "k", how)
        salted = skew.lookup(many, one, "k", how, task_rows=1_000, broadcast_rows=0)
        assert salted.columns == plain.columns
        assert salted.exceptAll(plain).isEmpty() and salted.count() == plain.count()


def test_relation_and_row_diff(spark):
    schema = "id int, v string"
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], schema)
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (4, "w")], schema)
    assert {tuple(r) for r in diff.relation_diff(a, b).collect()} == {("left", 3, "z"), ("right", 3, "y"), ("right", 4, "w")}
    unique = a.distinct()
    assert {tuple(r) for r in diff.row_diff(unique, b.where("id <> 1"), ["id"]).collect()} == {
        (1, "removed"), (3, "changed"), (4, "added"),
    }


def test_row_diff_of_repeated_and_null_keys(spark):
    schema = "k int, v string"
    a = spark.createDataFrame([(1, "x")] * 300 + [(2, "x"), (2, "y"), (None, "n"), (3, "z"), (5, "q")], schema)
    b = spark.createDataFrame([(1, "x")] * 300 + [(2, "y"), (2, "x"), (2, "x"), (None, "m"), (4, "z"), (4, "z"), (5, None)], schema)
    assert {tuple(r) for r in diff.row_diff(a, b, ["k"]).collect()} == {(2, "repeated"), (None, "changed"), (3, "removed"), (4, "added"), (5, "changed")}
    assert diff.row_diff(a, a, ["k"]).isEmpty()


def test_lookup_spreads_null_keys(spark):
    many = spark.range(20_000).select(F.expr("if(id % 2 = 0, null, id % 50)").alias("k"), "id")
    one = spark.range(40).select(F.col("id").alias("k"), (F.col("id") + 1).alias("v"))
    plain = many.join(one, "k", "left")
    for task_rows in (1_000, 10**9):
        found = skew.lookup(many, one, "k", "left", task_rows=task_rows, broadcast_rows=0)
        assert found.columns == plain.columns and found.exceptAll(plain).isEmpty() and found.count() == plain.count()


def test_keys_ignore_nulls(spark):
    child = spark.createDataFrame([(1,), (1,), (None,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert [tuple(r) for r in keys.orphans(child, "fk", parent, "pk").collect()] == [(9, 1)]
    profile = keys.reference_profile(parent, "pk", [(child, "fk"), (parent, "pk")])
    assert {tuple(r) for r in profile.collect()} == {(1, 1, 2, 1), (2, 1, 0, 1), (9, 0, 1, 0)}
    assert [tuple(r) for r in keys.duplicates(child, ["fk"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in keys.without_children(parent, "pk", child, "fk").collect()] == [(2,)]


def test_keyset_pages_walk_the_whole_order(spark, shop):
    orders = shop["orders"].where("customer_id = 1").select("created_at", "id")
    expected = [tuple(r) for r in orders.orderBy("created_at", "id").collect()]
    seen, cursor = [], None
    while True:
        page = commerce.keyset_page(orders, ["created_at", "id"], 200, cursor).collect()
        if not page:
            break
        seen += [tuple(r) for r in page]
        cursor = [F.lit(page[-1].created_at), F.lit(page[-1].id)]
    assert seen == expected and len(seen) == 752


def test_receipts_do_not_count_attempts_twice(shop):
    row = commerce.receipts(shop["payments"], "status", "amount").first()
    assert row.gross == row.refunded + row.net and row.refunded > 0
    naive = shop["payments"].agg(F.sum("amount")).first()[0]
    assert naive > row.gross


def test_running_balance_and_ledger(shop):
    balances = commerce.running_balance(shop["inventory_movements"], "product_id", ["created_at", "id"], "quantity_delta", task_rows=2_000)
    latest = balances.groupBy("product_id").agg(F.max_by("balance", F.struct("created_at", "id")).alias("last"), F.sum("quantity_delta").alias("net"))
    assert latest.where("last <> net").isEmpty()
    assert {r.product_id: r.net for r in latest.where("product_id <= 3").collect()} == {1: 0, 2: 1, 3: -1}


def test_date_ranges_of_published_data(shop):
    ranges = {r.column_name: (str(r.first_at), str(r.last_at)) for r in profiling.date_ranges(shop).collect()}
    assert ranges["customers.created_at"] == ("2023-01-01 10:45:28", "2023-12-31 23:17:48")
    assert ranges["orders.created_at"] == ("2024-01-01 04:00:00", "2024-12-31 23:30:00")
    assert ranges["shipments.delivered_at"] == ("2024-01-04 04:00:00", "2025-01-03 23:30:00")
    assert len(ranges) == 8


def test_odd_column_names_are_quoted(spark):
    odd = spark.createDataFrame([(1, None), (None, None)], "`select` int, `a.b ``c` string")
    assert {tuple(r) for r in profiling.null_counts({"t": odd}).collect()} == {("t.select", 1), ("t.a.b `c", 2)}
