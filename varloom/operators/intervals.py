"""Joins of spans by position, in bins of several widths.

Level ``i`` cuts a sequence into bins of ``128 * 8**i`` positions, the last level into one. A span belongs to
the first level whose bins are wider than the span, where it lies in at most two bins: a row or two,
however long it is. What it is compared with goes to the bins of the levels that spans are on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Widths of the levels as powers of two; one more level has a single bin.
SHIFTS = tuple(range(7, 32, 3))
#: Parts of a bin, as a power of two, of which the first and last point stand for all: see :func:`covering`.
PARTS = 4


def _long(value: int | Column) -> Column:
    return F.lit(value).cast("bigint") if isinstance(value, int) else value.cast("bigint")


def level(start: Column, last: Column) -> Column:
    """Level of a span."""
    reach = last - start
    at = F.when(reach < 1 << SHIFTS[0], 0)
    for i, shift in enumerate(SHIFTS[1:], 1):
        at = at.when(reach < F.lit(1 << shift), i)
    return at.otherwise(len(SHIFTS)).cast("int")


def bin_at(level: Column, position: Column) -> Column:
    """Bin of a position on a level."""
    place = F.call_function("shiftright", _long(position), F.lit(SHIFTS[0]) + level * 3)
    return F.when(level < len(SHIFTS), place).otherwise(_long(0))


def span_bins(start: Column, last: Column) -> Column:
    """The one or two ``(level, bin)`` of a span; none where an end is missing."""
    on = level(start, last)

    def at(position: Column) -> Column:
        return F.struct(on.alias("level"), bin_at(on, position).alias("bin"))

    return F.when(start.isNotNull() & last.isNotNull(), F.array_distinct(F.array(at(start), at(last))))


def levels_of(spans: DataFrame, start: str, last: str) -> list[int]:
    """The levels that spans are on, at most one for every width."""
    on = spans.filter(F.col(start).isNotNull() & F.col(last).isNotNull()).select(level(F.col(start), F.col(last)).alias("level"))
    return sorted(r.level for r in on.distinct().collect())


def thinned(points: DataFrame, key: str, position: str) -> DataFrame:
    """``key, level, bin, position``: points enough to tell for any span whether it covers one.

    A span of a level is longer than two parts of its bins, but for the first level, where all points
    stay. So it never begins and ends in one part, and of the points of a part it covers one only if it
    covers the first or the last. However many points there are, a bin has a bounded number of rows.
    """
    rows = points.select(key, F.col(position).cast("bigint").alias(position)).distinct()
    own = rows.filter(F.col(position).isNotNull())
    first = own.select(key, F.lit(0).alias("level"), bin_at(F.lit(0), F.col(position)).alias("bin"), position)
    # The level with a single bin has spans longer than the bins of the level before it.
    higher = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.lit(SHIFTS[i] if i < len(SHIFTS) else SHIFTS[-1] + 3).alias("shift")) for i in range(1, len(SHIFTS) + 1)]))
    parts = own.select(key, position, higher.alias("_on"))
    parts = parts.select(key, position, "_on.level", F.call_function("shiftright", F.col(position), F.col("_on.shift") - PARTS).alias("_part"))
    ends = parts.groupBy(key, "level", "_part").agg(F.min(position).alias("_min"), F.max(position).alias("_max"))
    ends = ends.select(key, "level", F.explode(F.array_distinct(F.array("_min", "_max"))).alias(position))
    return first.unionByName(ends.select(key, "level", bin_at(F.col("level"), F.col(position)).alias("bin"), position))


def covering(spans: DataFrame, points: DataFrame, key: str, start: str, last: str, position: str) -> DataFrame:
    """Rows of ``spans`` that cover a row of ``points``, of the same ``key``, once or twice each.

    ``spans`` should be narrow: its rows are shuffled, one or two for each. Points become up to twenty rows
    each and Spark's estimate, from the size of their files, has them as one: both sides are always sorted,
    as a broadcast that looks small would take all of the driver's memory.
    """
    rows = spans.withColumn("_at", F.explode(span_bins(F.col(start), F.col(last)))).alias("s")
    some = thinned(points, key, position).alias("p").hint("merge")
    met = (
        (F.col(f"s.{key}") == F.col(f"p.{key}"))
        & (F.col("s._at.level") == F.col("p.level"))
        & (F.col("s._at.bin") == F.col("p.bin"))
        & F.col(f"p.{position}").between(F.col(f"s.{start}"), F.col(f"s.{last}"))
    )
    return rows.join(some, met, "left_semi").drop("_at")


def overlaps(left: DataFrame, right: DataFrame, key: str, left_ends: tuple[str, str], right_ends: tuple[str, str]) -> DataFrame:
    """Every pair of overlapping spans with equal ``key``, once. Other columns of the two must differ in name.

    A pair meets on the wider level of the two: once among left spans wider or as wide, once among right
    spans wider. It counts in the bin where the later of the two begins, so none comes twice.
    """
    renamed = right.withColumnRenamed(key, "_key")

    def at_own(df: DataFrame, ends: tuple[str, str], name: str) -> DataFrame:
        return df.withColumn(name, F.explode(span_bins(F.col(ends[0]), F.col(ends[1]))))

    def at_wider(df: DataFrame, ends: tuple[str, str], name: str, levels: list[int], equal: bool) -> DataFrame:
        own = level(F.col(ends[0]), F.col(ends[1]))
        wider = [i for i in levels if equal or i > 0]

        def bins(i: Column) -> Column:
            one, two = bin_at(i, F.col(ends[0])), bin_at(i, F.col(ends[1]))
            return F.transform(F.array_distinct(F.array(one, two)), lambda b: F.struct(i.alias("level"), b.alias("bin")))

        fit = F.filter(F.array(*[F.lit(i) for i in wider]).cast("array<int>"), lambda i: (i >= own) if equal else (i > own))
        return df.withColumn(name, F.explode(F.flatten(F.transform(fit, bins))))

    def met(one: DataFrame, other: DataFrame) -> DataFrame:
        later = F.greatest(F.col(left_ends[0]), F.col(right_ends[0]))
        on = (
            (F.col(key) == F.col("_key"))
            & (F.col("_left.level") == F.col("_right.level"))
            & (F.col("_left.bin") == F.col("_right.bin"))
            & (F.col(left_ends[0]) <= F.col(right_ends[1]))
            & (F.col(right_ends[0]) <= F.col(left_ends[1]))
            & (bin_at(F.col("_left.level"), later) == F.col("_left.bin"))
        )
        return one.join(other, on).drop("_left", "_right", "_key")

    wide_left = met(at_own(left, left_ends, "_left"), at_wider(renamed, right_ends, "_right", levels_of(left, *left_ends), True))
    wide_right = met(at_wider(left, left_ends, "_left", levels_of(right, *right_ends), False), at_own(renamed, right_ends, "_right"))
    return wide_left.unionByName(wide_right)
