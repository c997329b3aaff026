"""Resharding by minimum-cost flow: from old shard sizes to new capacities, moving the fewest bytes.

The flow between shards is solved on the driver over one number per shard. Rows of an old shard lie on a
line, in blocks of one size class and hash range, large rows first. The line is cut by the flow: what a
shard keeps comes first, so the ends of transfers meet small rows, and a row goes where its middle lies.
Only shards that give or receive rows are written again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import fresh, store
from varloom.session import new_path

#: Bytes of a block, about; the number of hash ranges follows the size of the largest shard.
BLOCK_BYTES = 16 << 20
LEAST_RANGES = 16
NEW = -1
#: Names that columns have on the way.
OWN = {
    "old_shard", "new_shard", "line", "shard", "slot", "row_size", "row_key", "size_class", "row_range", "middle", "cuts",
    "bytes", "rows", "bytes_before", "rows_before", "base", "first",
}


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) and one more."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def min_cost_flow(supply: list[int], demand: list[int], cost: np.ndarray) -> np.ndarray:
    """Flow from each supply to each demand (equal sums) of least total cost, by shortest augmenting paths."""
    n, m = len(supply), len(demand)
    flow = np.zeros((n, m), dtype=np.int64)
    left, open_ = np.array(supply, dtype=np.int64), np.array(demand, dtype=np.int64)
    rows, columns = np.arange(n), np.arange(m)
    while left.sum():
        # Distances from supplies that are left, over forward edges and, where there is flow, back.
        far = np.where(left > 0, 0.0, np.inf)
        far_to, by, back = np.full(m, np.inf), np.zeros(m, dtype=int), np.full(n, -1)
        while True:
            step = far[:, None] + cost
            reach = step.min(axis=0)
            closer = reach < far_to - 1e-9
            by[closer], far_to[closer] = step.argmin(axis=0)[closer], reach[closer]
            undo = np.where(flow > 0, far_to[None, :] - cost, np.inf)
            again = undo.min(axis=1)
            nearer = again < far - 1e-9
            if not nearer.any():
                break
            back[nearer], far[nearer] = undo.argmin(axis=1)[nearer], again[nearer]
        j = int(np.where(open_ > 0, far_to, np.inf).argmin())
        path, amount, end = [], int(open_[j]), j
        while True:
            i = int(by[j])
            path.append((i, j, 1))
            if back[i] < 0:
                break
            j = int(back[i])
            path.append((i, j, -1))
            amount = min(amount, int(flow[i, j]))
        amount = min(amount, int(left[i]))
        for a, b, sign in path:
            flow[a, b] += sign * amount
        left[i] -= amount
        open_[end] -= amount
    assert (flow.sum(axis=1) == supply).all() and (flow.sum(axis=0)[columns] == demand).all() and len(rows) == n
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


@dataclass(frozen=True)
class Plan:
    """Per old shard the ends of its cuts on the line and where they go; shards that change; bytes moved."""

    cuts: dict[int, list[tuple[int, int]]]
    changed: set[int]
    moved: int


def solve(old: dict[int, int], capacities: list[int], cost: np.ndarray | None = None) -> Plan:
    """The plan from sizes of old shards. ``cost`` is per byte; by default staying is free, moving costs 1."""
    shards = sorted(old)
    if not shards:
        return Plan({}, set(), 0)
    if cost is None:
        cost = np.array([[0.0 if i == j else 1.0 for j in range(len(capacities))] for i in shards])
    flow = min_cost_flow([old[i] for i in shards], capacities, cost)
    cuts: dict[int, list[tuple[int, int]]] = {}
    changed, moved = set(), 0
    for row, i in enumerate(shards):
        order = sorted(np.flatnonzero(flow[row]).tolist(), key=lambda j: (j != i, j))
        end, cuts[i] = 0, []
        for j in order:
            end += int(flow[row, j])
            cuts[i].append((end, j))
            if i != j:
                moved += int(flow[row, j])
                changed |= {i, j}
    return Plan(cuts, changed, moved)


def reshard(docs: DataFrame, old: Column, shards: int, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, Plan]:
    """``docs`` columns with ``old_shard, new_shard, line`` (place on the old shard's line), and the plan.

    ``old`` is the number of the shard that holds a row; null marks a row that no shard holds yet. Sizes
    of new shards differ by a few rows' bytes at most. An empty table gives no row and an empty plan. Null
    and very long texts have their size; rows that repeat each other each have a place. Columns of
    ``docs`` with a name of :data:`OWN` come back with an underscore in front; not ``doc_id`` and ``text``.
    """
    spark = docs.sparkSession
    size = row_size(F.col(text))
    held = docs.select("*", F.coalesce(old.cast("int"), F.lit(NEW)).alias(fresh(docs, "old_shard")))
    *names, last = held.columns
    taken = [c for c in names if c.lower() in OWN]
    for name in taken:
        held = held.withColumnRenamed(name, fresh(held, f"_{name}"))
    base = held.withColumnRenamed(last, "old_shard").withColumn("row_size", size)
    columns = held.columns[:-1]
    sizes = {r.old_shard: r.bytes for r in base.groupBy("old_shard").agg(F.sum("row_size").alias("bytes")).collect()}
    plan = solve(sizes, even_capacities(sum(sizes.values()), shards))
    ranges = max(LEAST_RANGES, -(-max(sizes.values(), default=0) // BLOCK_BYTES))
    key = F.xxhash64(F.col(doc_id), F.col(text))
    base = base.withColumns(
        {"row_key": key, "size_class": F.length(F.bin("row_size")), "row_range": F.pmod(key, F.lit(ranges)).cast("int")}
    )
    block = ["old_shard", "size_class", "row_range"]
    line = Window.partitionBy("old_shard").orderBy(F.desc("size_class"), "row_range")
    blocks = base.groupBy(*block).agg(F.sum("row_size").alias("bytes"), F.count("*").alias("rows"))
    blocks = blocks.withColumn("bytes_before", F.sum("bytes").over(line) - F.col("bytes"))
    blocks = blocks.withColumn("rows_before", F.sum("rows").over(line) - F.col("rows")).drop("bytes", "rows")
    blocks = store(blocks, "blocks")
    inside = Window.partitionBy(*block).orderBy(F.desc("row_size"), "row_key", doc_id)
    placed = base.join(blocks, block).withColumn("line", F.col("rows_before") + F.row_number().over(inside) - 1)
    run = F.sum("row_size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.withColumn("middle", 2 * (F.col("bytes_before") + run) - F.col("row_size"))
    cuts = [(i, [(2 * end, j) for end, j in ends]) for i, ends in plan.cuts.items()]
    # One row per old shard.
    table = F.broadcast(spark.createDataFrame(cuts, "old_shard int, cuts array<struct<end: long, shard: int>>"))
    placed = placed.join(table, "old_shard")
    new = F.filter("cuts", lambda c: F.col("middle") < c["end"])[0]["shard"]
    return placed.withColumn("new_shard", new).select(*columns, "old_shard", "new_shard", "line"), plan


def rewrite(placed: DataFrame, plan: Plan, path: str | None = None) -> DataFrame:
    """Write the shards that change, one folder each, and return them with the others, as read.

    Rows of an unchanged shard keep their files; here they come from ``placed``.
    """
    spark = placed.sparkSession
    path = path or new_path(spark, "shards")
    changed = F.col("new_shard").isin(sorted(plan.changed)) if plan.changed else F.lit(False)
    placed.filter(changed).withColumn("shard", F.col("new_shard")).write.partitionBy("shard").parquet(path)
    written = spark.read.schema(placed.withColumn("shard", F.col("new_shard")).schema).parquet(path).drop("shard")
    if set(plan.cuts) <= plan.changed:
        return written
    return written.unionByName(placed.filter(~changed))


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``, a gapless number from 0 in each new shard.

    A transfer is a run of a line, so its first place and its count, one row per transfer, give the slots.
    """
    runs = rows.groupBy("old_shard", "new_shard").agg(F.min("line").alias("first"), F.count("*").alias("n"))
    order = Window.partitionBy("new_shard").orderBy("old_shard")
    runs = store(runs.withColumn("base", F.sum("n").over(order) - F.col("n")).drop("n"), "runs")
    return rows.join(F.broadcast(runs), ["old_shard", "new_shard"]).withColumn(
        "slot", F.col("base") + F.col("line") - F.col("first")
    ).drop("base", "first")
