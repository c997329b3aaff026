"""Tallies of a growing folder, kept up to date batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fold(stream: DataFrame, out: str, partial: Callable[[DataFrame], DataFrame]) -> None:
    """Store ``partial`` of what is new in ``stream`` since the last call, then return.

    Each batch has a folder named by its number, which a repeated batch replaces: after a failure nothing
    counts twice and nothing is missing. Progress is kept below ``out`` as well.
    """

    def keep(batch: DataFrame, number: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{out}/batches/batch={number}")

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{out}/progress").trigger(availableNow=True).start()
    query.awaitTermination()


def folded(spark: SparkSession, out: str) -> DataFrame:
    """The stored partial results, a row for each batch and group, with ``batch``."""
    return spark.read.parquet(f"{out}/batches")


def summed(partials: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """Partial counts of all batches added up."""
    return partials.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in counts])
