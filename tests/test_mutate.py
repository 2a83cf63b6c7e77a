from pyspark.sql import functions as F

from cartloom.contract.commerce import COMMERCE
from cartloom.contract.model import Check, Column, Contract, Reference, Table
from cartloom.operators import mutate

# A value that breaks a check, by the part of its name that says what it asks for.
BREAKING = {
    "nonempty": "'  '", "finite_amount": "-1", "one_of": "'?'", "positive": "0", "nonzero": "0", "not_self": "id",
}
BREAKING_ROWS = {
    "dates_follow_status": {"status": "'DELIVERED'", "delivered_at": "shipped_at - INTERVAL 1 SECOND"},
    "sign_follows_reason": {"quantity_delta": "-quantity_delta"},
}


def breaking_changes(table):
    """(op, changed columns, expected class, rule) for every rule of a table."""
    types = {c.name: c.type for c in table.columns}
    for kind, rule, _ in table.row_rules():
        column, _, wanted = rule.partition(".")
        if kind == "not_null" and column not in table.primary_key:
            yield "update", {column: f"CAST(NULL AS {types[column]})"}, kind, rule
        elif kind == "length":
            longest = next(c.max_length for c in table.columns if c.name == column)
            yield "update", {column: f"repeat('x', {longest + 1})"}, kind, rule
        elif kind == "check":
            yield "update", BREAKING_ROWS.get(rule) or {column: BREAKING[wanted]}, kind, rule
    for reference in table.references:
        yield "update", {reference.column: "-1L"}, "foreign_key", reference.column
    for unique in table.uniques:
        yield "update", {c: f"(SELECT {c} FROM {table.name}_view WHERE id = 2)" for c in unique}, "unique", "_".join(unique)
    yield "insert", {}, "unique", "id"
    yield "update", {"id": "id + 1000000000"}, "missing", "id"


def change(shop, name, key, op, assignments):
    row = shop[name].where(F.col("id") == key)
    return row.withColumns({c: F.expr(e) for c, e in assignments.items()}).withColumn("op", F.lit(op))


def test_a_write_against_any_rule_is_rejected_under_that_rule(shop):
    seen = 0
    for table in COMMERCE.tables:
        shop[table.name].createOrReplaceTempView(f"{table.name}_view")
        for op, assignments, violation, rule in breaking_changes(table):
            changes = change(shop, table.name, 1, op, assignments)
            found = {(r.violation, r.rule) for r in mutate.screen(changes, table, shop[table.name], shop).collect()}
            assert (violation, rule) in found, (table.name, assignments, found)
            if violation in ("check", "foreign_key", "not_null"):
                assert {v for v, _ in found} == {violation}, (table.name, assignments, found)
            seen += 1
    assert seen > 60


def test_batches_and_joint_deletes(spark):
    nodes = Table("nodes", (Column("id", "bigint"), Column("parent", "bigint", nullable=True)), references=(Reference("parent", "nodes"),))
    items = Table("items", (Column("id", "bigint"), Column("node", "bigint"), Column("n", "int")), references=(Reference("node", "nodes"),),
                  checks=(Check.compare("n", "> 0", "positive"),))
    both = Contract((nodes, items))
    tables = {"nodes": spark.createDataFrame([(1, None), (2, 1), (3, 2)], nodes.schema), "items": spark.createDataFrame([(1, 3, 5)], items.schema)}
    new_nodes = spark.createDataFrame([(10, 3, "insert"), (11, 10, "insert"), (12, 99, "insert"), (13, 12, "insert"), (14, 13, "insert"), (15, 15, "insert")],
                                      "id long, parent long, op string")
    new_items = spark.createDataFrame([(5, 11, 1, "insert"), (6, 14, 1, "insert"), (7, 10, 0, "insert")], "id long, node long, n int, op string")
    done = mutate.batch({"nodes": new_nodes, "items": new_items}, both, tables)
    assert {r.id for r in done["nodes"].table.collect()} == {1, 2, 3, 10, 11, 15}
    assert {r.id for r in done["items"].table.collect()} == {1, 5}
    assert {tuple(r) for r in done["nodes"].rejected.collect()} == {(12, "foreign_key", "parent"), (13, "foreign_key", "parent"), (14, "foreign_key", "parent")}
    assert {tuple(r) for r in done["items"].rejected.collect()} == {(6, "foreign_key", "node"), (7, "check", "n.positive")}
    # 3 is held by an item that stays, so its parents stay too; with the item all of them go.
    keys = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    kept = mutate.delete_batch({"nodes": keys}, both, tables)["nodes"]
    assert kept.table.count() == 3 and {r.id for r in kept.rejected.collect()} == {1, 2, 3}
    gone = mutate.delete_batch({"nodes": keys, "items": spark.createDataFrame([(1,)], "id long")}, both, tables)
    assert gone["nodes"].table.isEmpty() and gone["items"].table.isEmpty() and gone["nodes"].rejected.isEmpty()
    chain = {**tables, "items": tables["items"].limit(0)}
    assert mutate.delete_batch({"nodes": keys.where("id > 1")}, both, chain)["nodes"].table.count() == 1


def test_valid_changes_are_applied_and_bad_ones_left_out(spark, shop):
    good = change(shop, "products", 2, "update", {"price": "12.34"})
    new = change(shop, "products", 3, "insert", {"id": "9001L", "name": "'Fresh'"})
    bad = change(shop, "products", 4, "update", {"price": "-5"})
    missing = change(shop, "products", 5, "update", {"id": "9999L"})
    outcome = mutate.upsert(
        good.unionByName(new).unionByName(bad).unionByName(missing), COMMERCE["products"], shop["products"], shop
    )
    assert {tuple(r) for r in outcome.rejected.collect()} == {
        (4, "check", "price.finite_amount"), (9999, "missing", "id"),
    }
    after = {r.id: r for r in outcome.table.collect()}
    assert len(after) == 501 and str(after[2].price) == "12.34" and after[9001].name == "Fresh"
    assert after[4] == shop["products"].where("id = 4").first()
    assert outcome.table.schema.simpleString() == shop["products"].schema.simpleString()


def test_conflicts_inside_one_change_set(spark, shop):
    a = change(shop, "customers", 10, "update", {"email": "'same@example.test'"})
    b = change(shop, "customers", 11, "update", {"email": "'same@example.test'"})
    twice = change(shop, "customers", 12, "update", {"name": "'One'"}).unionByName(
        change(shop, "customers", 12, "update", {"name": "'Two'"})
    )
    outcome = mutate.upsert(a.unionByName(b).unionByName(twice), COMMERCE["customers"], shop["customers"], shop)
    assert {tuple(r) for r in outcome.rejected.collect()} == {
        (10, "unique", "email"), (11, "unique", "email"), (12, "unique", "email"), (12, "unique", "id"),
    }
    assert outcome.table.exceptAll(shop["customers"]).isEmpty() and outcome.table.count() == 2000


def test_delete_keeps_referenced_rows(shop):
    outcome = mutate.delete(
        shop["customers"], F.col("id") >= 1700, COMMERCE["customers"], {"orders.customer_id": (shop["orders"], "customer_id")}
    )
    doomed = {r.id for r in shop["customers"].where("id >= 1700").collect()}
    used = {r.customer_id for r in shop["orders"].where("customer_id >= 1700").select("customer_id").distinct().collect()}
    assert {r.id for r in outcome.rejected.collect()} == used and used
    assert {r.id for r in outcome.table.collect()} == set(range(1, 2001)) - (doomed - used)


def test_updates_and_deletes_follow_three_valued_logic(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, v int")
    assert [tuple(r) for r in mutate.delete_where(df, F.col("v") > 6).orderBy("id").collect()] == [(1, 5), (2, None)]
    updated = mutate.update_where(df, F.col("v") > 6, {"v": F.lit(0)}).orderBy("id").collect()
    assert [tuple(r) for r in updated] == [(1, 5), (2, None), (3, 0)]
    source = spark.createDataFrame([(1, None), (3, 30)], "id int, v int")
    merged = mutate.update_from(df, source, "id", ["v"]).orderBy("id").collect()
    assert [tuple(r) for r in merged] == [(1, None), (2, None), (3, 30)]


def test_large_change_sets_take_the_shuffle_path(spark, shop, monkeypatch):
    changes = shop["products"].where("id <= 60").withColumns({
        "price": F.expr("IF(id % 7 = 0, -1, price)"),
        "category_id": F.expr("IF(id % 3 = 0, -5, category_id)"),
        "op": F.lit("update"),
    })
    doomed, children = F.col("id") >= 1700, {"orders.customer_id": (shop["orders"], "customer_id")}
    results = []
    for limit in (mutate.BROADCAST_ROWS, 0):
        monkeypatch.setattr(mutate, "BROADCAST_ROWS", limit)
        upserted = mutate.upsert(changes, COMMERCE["products"], shop["products"], shop)
        deleted = mutate.delete(shop["customers"], doomed, COMMERCE["customers"], children)
        results.append([sorted(map(tuple, df.collect())) for df in (upserted.table, upserted.rejected, deleted.table, deleted.rejected)])
    assert results[0] == results[1] and len(results[0][1]) == 20 + 8
