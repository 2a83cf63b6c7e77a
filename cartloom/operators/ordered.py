"""Row numbers, running sums and previous values in an order, per key or over a whole table.

A prefix scan with one shuffle, on one path for every size and every skew. Rows are dealt to parts by ranges of (key,
order), so a key of any size spreads over consecutive parts; the borders come from a bounded sample. Each part is
scanned by itself and written once; a task takes as many consecutive parts as hold ``SCAN_ROWS`` rows, so tasks and what they
report to the driver follow the rows, however small the parts are. What a part owes to the ones before it concerns its first key only, and is found from one
small row per part: the totals of its last key, scanned over the parts. The input is counted, sampled and then read
once in full; everything after that reads what was written. Rows that fill one part only need no borders, and their keys
spread them over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.operators.skew import SAMPLE_SEED, broadcast_if_small
from cartloom.session import cut_lineage

SCAN_ROWS = 1_000_000
TABLE_ROWS = 100_000  # of a part where there are no keys that spread the rows of a single part
MAX_PARTS = 20_000
SAMPLES_PER_PART = 64
SAMPLE_ROWS_PER_TASK = 50_000
BORDER_BYTES = 8 << 20
_PART, _TASK, _POSITION, _FOUND, _ALL, _FIRST = "part__", "task__", "position__", "found__", "all__", "first__"


def _position(columns: list[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(columns)])


def _borders(rows: DataFrame, columns: list[str], part_rows: int, total: int) -> tuple[DataFrame, int] | None:
    """(one row with the ascending first positions of all parts but the first, how many); None if one part will do.

    There are at most ``MAX_PARTS`` parts, and fewer where the positions are wide: all of them take ``BORDER_BYTES`` at most.
    The sample is ordered in few ranges, each of which is cut into equally many parts, so the driver is sent no more than a few
    rows per range.
    """
    parts = min(MAX_PARTS, -(-total // part_rows))
    if parts <= 1:
        return None
    fraction = min(1.0, SAMPLES_PER_PART * parts / total)
    sample = rows.select(*columns)
    sample = sample if fraction >= 1.0 else sample.sample(fraction=fraction, seed=SAMPLE_SEED)
    ranges = min(parts, max(1, -(-int(total * fraction) // SAMPLE_ROWS_PER_TASK)))
    ranged = sample.repartitionByRange(ranges, *columns).select(_position(columns).alias("start"), F.spark_partition_id().alias("p"))
    place = F.row_number().over(Window.partitionBy("p").orderBy("start")) - 1
    placed = ranged.select("start", (place * F.lit(parts // ranges).cast("bigint")).alias("i"), F.count("p").over(Window.partitionBy("p")).alias("n"))
    starts = cut_lineage(placed.where(F.col("i") % F.col("n") < parts // ranges).select("start"))
    size = starts.agg(F.sum(F.octet_length(F.to_json(F.struct("start"))))).first()[0] or 0
    step = max(1, -(-size // BORDER_BYTES))
    ordered = F.sort_array(F.collect_list("start"))
    borders = cut_lineage(starts.agg(F.filter(ordered, lambda _, i: (i > 0) & (i % step == 0)).alias("borders")))
    n = borders.select(F.size("borders")).first()[0]
    return (borders, n) if n else None


def in_ranges(rows: DataFrame, columns: list[str], part_rows: int = SCAN_ROWS) -> tuple[DataFrame, int]:
    """(``rows`` with their part in ``part__``, number of parts): parts hold about ``part_rows`` rows and ascend in ``columns``.

    A row's part is the number of borders at or before it, by binary search in steps that compile to plain code.
    """
    return _placed(rows, columns, part_rows, rows.count())


def _placed(rows: DataFrame, columns: list[str], part_rows: int, total: int) -> tuple[DataFrame, int]:
    found = _borders(rows, columns, part_rows, total)
    if found is None:
        return rows.withColumn(_PART, F.lit(0)), 1
    borders, n = found
    names = rows.columns
    placed = rows.select("*", _position(columns).alias(_POSITION), F.lit(0).alias(_FOUND))
    for step in [2**i for i in range(n.bit_length() - 1, -1, -1)]:
        probe = F.col(_FOUND) + step
        there = (probe <= n) & (F.get(borders.scalar(), probe - 1) <= F.col(_POSITION))
        placed = placed.select(*names, _POSITION, F.when(there, probe).otherwise(F.col(_FOUND)).alias(_FOUND))
    return placed.select(*names, F.col(_FOUND).alias(_PART)), n + 1


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    number: str | None = None,
    sums: dict[str, str] | None = None,
    previous: dict[str, str] | None = None,
    carried: dict[str, str] | None = None,
    backwards: bool = False,
    task_rows: int = SCAN_ROWS,
) -> DataFrame:
    """``df`` plus a row number, running sums, previous and carried values per key, in ascending ``order``.

    ``sums``, ``previous`` and ``carried`` map new column names to source columns: sums up to the row, the value of the row
    before, the last value that is not NULL up to the row. ``backwards`` walks every key from its last row to its first.
    ``order`` must be free of NULLs and unique inside a key; end it with a unique id. No ``keys`` means one order over the whole
    table. A NULL key is a key. A running sum is NULL until the first value that is not; it keeps its type over parts.
    """
    sums, previous, carried = dict(sums or {}), dict(previous or {}), dict(carried or {})
    walk = keys or [_ALL], order, number, sums, previous, carried, backwards
    rows = df if keys else df.withColumn(_ALL, F.lit(0))
    keys = keys or [_ALL]
    total = rows.count()
    placed, parts = _placed(rows, [*keys, *order], task_rows, total)
    if parts == 1:
        return _scanned(placed, *walk).drop(_ALL, _PART, _FIRST)
    # Parts of a task: as many as hold SCAN_ROWS rows, but no fewer tasks than cores.
    cores = df.sparkSession.sparkContext.defaultParallelism
    held = max(1, min(SCAN_ROWS * parts // total, -(-parts // cores)))
    dealt = placed.withColumn(_TASK, F.call_function("div", F.col(_PART), F.lit(held)).cast("int"))
    local = cut_lineage(_scanned(dealt.repartitionById(-(-parts // held), F.col(_TASK)), *walk, task=[_TASK]).drop(_TASK))
    carries = broadcast_if_small(_carries(local, *walk))

    owed = F.col("from__").isNotNull()
    for c in keys:
        owed = owed & local[c].eqNullSafe(carries[f"{c}__key"])
    wanted = []
    for c in local.columns:
        kind = local.schema[c].dataType
        if c in sums or c == number:
            carry = F.when(owed, carries[f"{c}__before"])
            value = F.coalesce(local[c] + F.coalesce(carry, F.lit(0)).cast(kind), carry.cast(kind)).cast(kind)
            wanted.append(value.alias(c))
        elif c in previous:
            wanted.append(F.when(owed & local[_FIRST], carries[f"{c}__before"]).otherwise(local[c]).alias(c))
        elif c in carried:
            wanted.append(F.coalesce(local[c], F.when(owed, carries[f"{c}__before"])).alias(c))
        elif c not in (_PART, _ALL, _FIRST):
            wanted.append(local[c])
    return local.join(carries, local[_PART] == carries["from__"], "left").select(*wanted)


def _scanned(
    placed: DataFrame, keys: list[str], order: list[str], number: str | None,
    sums: dict[str, str], previous: dict[str, str], carried: dict[str, str], backwards: bool, task: list[str] = (),
) -> DataFrame:
    """Windows inside the parts, which need no shuffle of their own; marks the first row of a key in a part."""
    window = Window.partitionBy(*task, _PART, *keys).orderBy(*[F.desc(c) if backwards else F.asc(c) for c in order])
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {_FIRST: F.row_number().over(window) == 1} if previous else {}
    if number:
        added[number] = F.row_number().over(window).cast("bigint")
    for name, source in sums.items():
        added[name] = F.sum(source).over(running)
    for name, source in previous.items():
        added[name] = F.lag(source).over(window)
    for name, source in carried.items():
        added[name] = F.last(source, ignorenulls=True).over(running)
    return placed.withColumns(added)


def _carries(
    local: DataFrame, keys: list[str], order: list[str], number: str | None,
    sums: dict[str, str], previous: dict[str, str], carried: dict[str, str], backwards: bool,
) -> DataFrame:
    """(from__, <key>__key, <name>__before): what the parts before part ``from__`` hold of its first key; at most one row a part.

    A key that reaches into a part from before is the last key of every part from the one in which it starts, so the last row of
    each part is enough: its number and sums are the key's totals there. Walking backwards, first and last change places.
    """
    totals = [*([number] if number else []), *sums]
    values = [F.col(c) for c in [*totals, *carried]] + [F.struct(F.col(s).alias("v")).alias(c) for c, s in previous.items()]
    key = F.struct(*[F.col(c) for c in keys])
    first, last = (F.max, F.min_by) if backwards else (F.min, F.max_by)
    ends = local.groupBy(_PART).agg(
        first(key).alias("first"), last(F.struct(key.alias("key"), *values, F.lit(True).alias("held__")), _position([*keys, *order])).alias("last"))
    given = ends.select("last.key.*", F.col(_PART).alias("from__"), F.lit(1).alias("kind__"), *[f"last.{c}" for c in [*totals, *carried, *previous, "held__"]])
    asked = ends.select("first.*", F.col(_PART).alias("from__"), F.lit(0).alias("kind__"))
    parts = F.desc("from__") if backwards else F.asc("from__")
    before = Window.partitionBy(*keys).orderBy(parts, "kind__").rowsBetween(Window.unboundedPreceding, -1)
    owed = [F.sum(c).over(before).alias(f"{c}__before") for c in totals]
    owed += [F.last(c, ignorenulls=True).over(before).alias(f"{c}__before") for c in carried]
    owed += [F.last(c, ignorenulls=True).over(before).getField("v").alias(f"{c}__before") for c in previous]
    both = given.unionByName(asked, allowMissingColumns=True)
    summed = both.select("from__", "kind__", *[F.col(c).alias(f"{c}__key") for c in keys], F.count("held__").over(before).alias("parts__"), *owed)
    return cut_lineage(summed.where("kind__ = 0 AND parts__ > 0").drop("kind__", "parts__"))


def dense_row_number(df: DataFrame, order: list[str], name: str = "row_number", task_rows: int = TABLE_ROWS) -> DataFrame:
    """Number all rows 1..n in a unique order, without sending the table through one task."""
    return scan(df, [], order, number=name, task_rows=task_rows)


def next_match(
    left: DataFrame, right: DataFrame, keys: list[str], moment: str, ident: str, prefix: str = "next_", task_rows: int = SCAN_ROWS
) -> DataFrame:
    """Every row of ``left`` with the first row of ``right`` of its key that is strictly later, by (``moment``, ``ident``).

    Both sides have the columns ``keys``, ``moment`` and a unique ``ident``. One union, one walk backwards in time that carries the
    last row of ``right`` it met: no pairs are formed, and a key of any size spreads over parts. The columns of
    ``right`` but for the keys come with ``prefix``, NULL where nothing follows. A NULL key matches a NULL key; rows without
    a moment match nothing.
    """
    shape = right.schema
    timed = left.where(F.col(moment).isNotNull())
    place = [*[F.col(c) for c in keys], F.col(moment).alias("moment__"), F.col(ident).alias("ident__")]
    # Of equal moments the right rows come first, so the walk backwards meets the left ones before.
    one = timed.select(*place, F.lit(1).alias("side__"), F.struct(*timed.columns).alias("left__"), F.lit(None).cast(shape).alias("right__"))
    other = right.where(F.col(moment).isNotNull()).select(
        *place, F.lit(0).alias("side__"), F.lit(None).cast(left.schema).alias("left__"), F.struct(*right.columns).alias("right__"))
    walked = scan(one.unionByName(other), keys, ["moment__", "side__", "ident__"], carried={"match__": "right__"}, backwards=True, task_rows=task_rows)
    found = walked.where("side__ = 1").select("left__.*", *[F.col(f"match__.{c}").alias(f"{prefix}{c}") for c in right.columns if c not in keys])
    return found.unionByName(left.where(F.col(moment).isNull()), allowMissingColumns=True)


def ends(df: DataFrame, keys: list[str], order: list[str], first: dict[str, str] | None = None, last: dict[str, str] | None = None) -> DataFrame:
    """First and/or last row of every key as one aggregate; copies of a hot key merge before the shuffle.

    ``first`` and ``last`` map new column names to source columns.
    """
    picks, spread = [], []
    for side, chosen, by in (("first__", first, F.min_by), ("last__", last, F.max_by)):
        if not chosen:
            continue
        payload = F.struct(*[F.col(source).alias(name) for name, source in chosen.items()])
        picks.append(by(payload, F.struct(*order)).alias(side))
        spread += [F.col(f"{side}.{name}").alias(name) for name in chosen]
    return df.groupBy(*keys).agg(*picks).select(*keys, *spread)
