"""Row order on distributed data: ranks and fills that need no single partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.session import shared_dir


def with_rank(df: DataFrame, order: list[Column], name: str = "Rank") -> DataFrame:
    """Number the rows 1..n in ``order``, which must be a total order.

    A window without partitions would move every row to one task. Here the rows are sorted by
    range, the sorted rows are checkpointed so that their place is fixed, and the sizes of the
    partitions before a row give its offset. The offsets have one row per sort partition, which
    is what bounds the broadcast.
    """
    shared_dir(df.sparkSession)
    columns = df.columns
    placed = df.orderBy(*order).select(
        *columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")
    )
    placed = placed.checkpoint()
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"), F.min("_at").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    rank = (F.col("_offset") + F.col("_at") - F.col("_first") + 1).alias(name)
    return placed.join(F.broadcast(offsets), "_part").select(rank, *columns)


def fill_down_up(df: DataFrame, group: str, order: str, columns: list[str], chunk: Column) -> DataFrame:
    """Fill missing values from the last row before that has one, else from the first after.

    ``chunk`` must not decrease along ``order`` within a group. Windows run inside one group and
    chunk only, so a group that holds most of the rows is spread over its chunks; what a chunk
    hands to the next ones is one summary row.
    """
    rows = df.withColumn("_chunk", chunk)
    within = Window.partitionBy(group, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    down = rows.withColumns({f"_down_{c}": F.last(c, ignorenulls=True).over(within) for c in columns})

    # max and min over (order, value) pick the last and first value of a chunk; both combine
    # before the shuffle, and rows without a value do not count.
    def pair(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("at"), F.col(c).alias("value")))

    summary = rows.groupBy(group, "_chunk").agg(
        *[F.max(pair(c)).alias(f"_last_{c}") for c in columns],
        *[F.min(pair(c)).alias(f"_first_{c}") for c in columns],
    )
    chunks = Window.partitionBy(group).orderBy("_chunk")
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(group)
    handed = summary.select(
        F.col(group).alias("_group"),
        F.col("_chunk").alias("_of"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier)["value"].alias(f"_before_{c}") for c in columns],
        *[F.min(f"_first_{c}").over(everywhere)["value"].alias(f"_start_{c}") for c in columns],
    )
    match = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_chunk") == F.col("_of"))
    filled = down.join(handed, match, "left")
    return filled.select(
        *[
            F.coalesce(f"_down_{c}", f"_before_{c}", f"_start_{c}").alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def ordered_text(
    rows: DataFrame, keys: list[str], order: list[str], texts: dict[str, Column], between: str, chunk: Column
) -> DataFrame:
    """One row per ``keys``: for each of ``texts`` its values joined by ``between`` in ``order``, NULL values left out.

    A text with no values in a group is empty. ``chunk`` must not decrease along ``order``. A first step
    joins the values of one chunk, a second one the texts of the chunks: no list holds more than the rows
    of a chunk or the chunks of a group, however many rows a key has.
    """
    listed = {
        name: F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*order, value.alias("_text")))))["_text"]
        for name, value in texts.items()
    }
    some = rows.groupBy(*keys, chunk.alias("_chunk")).agg(
        *[F.when(F.size(found) > 0, F.array_join(found, between)).alias(name) for name, found in listed.items()]
    )
    whole = {
        name: F.array_join(F.array_sort(F.collect_list(F.when(F.col(name).isNotNull(), F.struct("_chunk", name))))[name], between)
        for name in texts
    }
    return some.groupBy(*keys).agg(*[text.alias(name) for name, text in whole.items()])
