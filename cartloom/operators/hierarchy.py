"""Trees stored as (id, parent_id) edges.

Depth and cycles come from pointer doubling: every round doubles the distance walked, so a tree of depth
d needs about log2(d) rounds and no path is ever carried. Only nodes that are somebody's parent take part
in the rounds; leaves read their parent's result at the end. Where paths are the result (``paths``), every round
appends the path of the node that the pointer leads to, so they too are whole after about log2(d) rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.operators.skew import TASK_ROWS, lookup
from cartloom.session import cut_lineage


def _inner_nodes(edges: DataFrame) -> DataFrame:
    parents = edges.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("id")).distinct()
    return edges.join(parents, "id", "left_semi")


def _walk(edges: DataFrame, task_rows: int) -> DataFrame:
    """(id, depth) of inner nodes; depth NULL means that the walk upwards runs into a cycle."""
    # jump: an ancestor `hops` edges up; depth: nodes on the way to the root, once it is known.
    state = cut_lineage(
        _inner_nodes(edges).select(
            "id",
            F.col("parent_id").alias("jump"),
            F.lit(1).cast("bigint").alias("hops"),
            F.when(F.col("parent_id").isNull(), F.lit(1).cast("bigint")).alias("depth"),
        )
    )
    open_nodes = state.where("depth IS NULL").count()
    while open_nodes:
        target = state.select(
            F.col("id").alias("jump"),
            F.col("jump").alias("next"),
            F.col("hops").alias("next_hops"),
            F.col("depth").alias("next_depth"),
            F.lit(True).alias("found"),
        )
        pending = lookup(state.where("depth IS NULL").select("id", "jump", "hops"), target, "jump", "left", task_rows)
        moved = pending.select(
            "id",
            F.col("next").alias("jump"),
            (F.col("hops") + F.coalesce("next_hops", F.lit(0))).alias("hops"),
            # A parent that does not exist ends the walk, like a root one step below it.
            F.when(F.col("found").isNull(), F.col("hops")).otherwise(F.col("hops") + F.col("next_depth")).alias("depth"),
        )
        state = cut_lineage(state.where("depth IS NOT NULL").unionByName(moved))
        still_open = state.where("depth IS NULL").count()
        # Depths in a forest have no gaps, so a round without progress leaves only cyclic walks.
        if still_open == open_nodes:
            break
        open_nodes = still_open
    return state.select("id", "depth")


def depths(edges: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """(id, parent_id, depth, cyclic): 1 for roots; NULL depth where the walk upwards meets a cycle."""
    inner = _walk(edges, task_rows).select(
        F.col("id").alias("parent_id"), F.col("depth").alias("parent_depth"), F.lit(True).alias("known")
    )
    placed = lookup(edges.select("id", "parent_id"), inner, "parent_id", "left", task_rows)
    depth = F.when(F.col("known").isNull(), F.lit(1).cast("bigint")).otherwise(F.col("parent_depth") + 1)
    return placed.select("id", "parent_id", depth.alias("depth"), depth.isNull().alias("cyclic"))


def _joined_up(steps: DataFrame, task_rows: int) -> DataFrame:
    """(id, path): ids from the root down to the node, for acyclic ``steps`` (id, parent_id) that hold every parent they name."""
    state = cut_lineage(steps.select("id", F.array("id").alias("path"), F.col("parent_id").alias("jump")))
    while not state.where("jump IS NOT NULL").isEmpty():
        target = state.select(F.col("id").alias("jump"), F.col("path").alias("upper"), F.col("jump").alias("next"))
        # The pointer of a node leads to the one above its path, so both halves meet without a gap.
        moved = lookup(state.where("jump IS NOT NULL"), target, "jump", "inner", task_rows, broadcast_rows=0).select(
            "id", F.concat("upper", "path").alias("path"), F.col("next").alias("jump"))
        state = cut_lineage(state.where("jump IS NULL").unionByName(moved))
    return state.select("id", "path")


def _on_cycles(steps: DataFrame, task_rows: int) -> tuple[DataFrame, DataFrame]:
    """((id, reached): a node on a cycle that each node of ``steps`` runs into; (id, parent_id, leader) of the nodes on cycles).

    All nodes of ``steps`` (id, parent_id) lead to a cycle, and all parents are among them. Walking 2^k steps from every node
    ends on cycles only once the number of ends stays the same; the leader is the least id of a cycle, from minima over 2^k steps.
    """
    walk = cut_lineage(steps.select("id", F.col("parent_id").alias("jump")))
    ends, before = walk.select("jump").distinct().count(), None
    while ends != before:
        further = walk.select(F.col("id").alias("jump"), F.col("jump").alias("next"))
        walk = cut_lineage(lookup(walk, further, "jump", "inner", task_rows).select("id", F.col("next").alias("jump")))
        before, ends = ends, walk.select("jump").distinct().count()
    reached = walk.select("id", F.col("jump").alias("reached"))
    ring = cut_lineage(steps.join(reached.select(F.col("reached").alias("id")).distinct(), "id", "left_semi"))
    state = cut_lineage(ring.select("id", F.col("parent_id").alias("jump"), F.col("id").alias("least")))
    changed = True
    while changed:
        further = state.select(F.col("id").alias("jump"), F.col("jump").alias("next"), F.col("least").alias("other"))
        state = cut_lineage(lookup(state, further, "jump", "inner", task_rows).select(
            "id", F.col("next").alias("jump"), F.least("least", "other").alias("least"), (F.col("other") < F.col("least")).alias("moved")))
        changed = not state.where("moved").isEmpty()
        state = state.drop("moved")
    return reached, ring.join(state.select("id", F.col("least").alias("leader")), "id")


def paths(edges: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """(id, parent_id, path, position, cycle) of every node of ``edges`` (id, parent_id).

    * ``path``: ids from the root down to the node. On a cycle it starts at the least id of the cycle, its leader, and goes
      down from parent to child; below a cycle there is none.
    * ``position``: the node's place in its path, from 1.
    * ``cycle``: the members of the cycle that the walk upwards meets, as the path of its last member; NULL if it meets none.

    A parent that does not exist ends the walk; the path starts below it. Rounds follow log2 of the longest path, the longest way
    into a cycle, and the longest cycle; path lengths add up to the result's own size. Ids are unique and not NULL.
    """
    edges = edges.select("id", "parent_id")
    inner = cut_lineage(_inner_nodes(edges))
    shaped = depths(inner, task_rows)
    sound = cut_lineage(shaped.where("NOT cyclic").select("id", "parent_id"))
    # A parent outside the inner nodes does not exist.
    there = sound.select(F.col("id").alias("parent_id"), F.lit(True).alias("there"))
    rooted = lookup(sound, there, "parent_id", "left", task_rows).select("id", F.when(F.col("there"), F.col("parent_id")).alias("parent_id"))
    upper = _joined_up(rooted, task_rows).select("id", "path", F.lit(None).cast(inner.schema["id"].dataType).alias("leader"), F.lit(False).alias("looped"))
    looped = cut_lineage(shaped.where("cyclic").select("id", "parent_id"))
    if looped.isEmpty():
        members = upper.select("leader", F.col("path").alias("cycle")).limit(0)
    else:
        reached, ring = _on_cycles(looped, task_rows)
        ring = cut_lineage(ring)
        opened = ring.select("id", F.when(F.col("id") != F.col("leader"), F.col("parent_id")).alias("parent_id"))
        around = cut_lineage(_joined_up(opened, task_rows).join(ring.select("id", "leader"), "id"))
        members = around.groupBy("leader").agg(F.max_by("path", F.size("path")).alias("cycle"))
        led = reached.join(ring.select(F.col("id").alias("reached"), "leader"), "reached").select("id", "leader")
        own = led.join(around.select("id", "path"), "id", "left").select("id", "path", "leader", F.lit(True).alias("looped"))
        upper = upper.unionByName(own)
    upper = cut_lineage(upper)
    leaves = edges.join(inner.select("id"), "id", "left_anti")
    above = upper.select(F.col("id").alias("parent_id"), F.col("path").alias("upper"), "leader", "looped")
    # A leaf below a sound parent has that parent's path and itself; one below a loop has none.
    hung = lookup(leaves, above, "parent_id", "left", task_rows, broadcast_rows=0).select(
        "id", "parent_id", F.when(~F.coalesce("looped", F.lit(False)), F.concat(F.coalesce("upper", F.array().cast(upper.schema["path"].dataType)), F.array("id"))).alias("path"), "leader")
    whole = inner.select("id", "parent_id").join(upper.select("id", "path", "leader"), "id").unionByName(hung)
    placed = lookup(whole, members, "leader", "left", task_rows, broadcast_rows=0)
    return placed.select("id", "parent_id", "path", F.when(F.col("path").isNotNull(), F.size("path")).alias("position"), "cycle")


def summary(edges: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """One row: nodes, max_depth, cyclic_nodes."""
    return depths(edges, task_rows).agg(
        F.count(F.lit(1)).alias("nodes"),
        F.max("depth").alias("max_depth"),
        F.count_if("cyclic").alias("cyclic_nodes"),
    )


def children(nodes: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """(parent_id, parent_name, id, name) of every edge of a (id, parent_id, name) node list."""
    parents = _inner_nodes(nodes).select(F.col("id").alias("parent_id"), F.col("name").alias("parent_name"))
    listed = nodes.where("parent_id IS NOT NULL").select("parent_id", "id", "name")
    return lookup(listed, parents, "parent_id", "inner", task_rows).select("parent_id", "parent_name", "id", "name")


def rollup(edges: DataFrame, measures: DataFrame, aggregates: dict[str, str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Sum measures of every node into itself and all its ancestors.

    ``measures`` holds (id, <columns>), any number of rows per id; ``aggregates`` maps output to source
    column. Leaves add to their parent once; then sums double their reach: after k rounds an inner node holds the
    sums of all inner nodes less than 2^k edges below it, and its pointer leads 2^k edges up. So a tree of depth d
    takes about log2(d) rounds, and a parent with very many children is merged before the shuffle. A cycle is an error.
    """
    inner = cut_lineage(_inner_nodes(edges).select("id", "parent_id"))
    shape = summary(inner, task_rows).first()
    if shape.cyclic_nodes:
        raise ValueError(f"{shape.cyclic_nodes} inner nodes of the tree lie on or below a cycle")
    sums = [F.sum(name).alias(name) for name in aggregates]
    own = cut_lineage(measures.groupBy("id").agg(*[F.sum(source).alias(name) for name, source in aggregates.items()]))
    leaves = own.join(inner.select("id"), "id", "left_anti")
    first = edges.where("parent_id IS NOT NULL").select("id", "parent_id").join(leaves, "id")
    lifted = first.groupBy(F.col("parent_id").alias("id")).agg(*sums)
    held = own.join(inner.select("id"), "id", "left_semi")
    reach = cut_lineage(held.unionByName(lifted).groupBy("id").agg(*sums))
    pointers = inner.where("parent_id IS NOT NULL").select("id", F.col("parent_id").alias("up"))
    while not pointers.isEmpty():
        moved = reach.join(pointers, "id").groupBy(F.col("up").alias("id")).agg(*sums)
        reach = cut_lineage(reach.unionByName(moved).groupBy("id").agg(*sums))
        further = pointers.select(F.col("id").alias("up"), F.col("up").alias("next"))
        pointers = cut_lineage(pointers.join(further, "up").select("id", F.col("next").alias("up")))
    return leaves.unionByName(reach)
