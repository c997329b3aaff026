"""Mixing sources to target weights by capped water-filling.

Every source asks for a share of the total by its weight, but may be repeated at most ``max_epochs``
times: a source whose share is above that is clamped, and its excess goes to the others by weight, again
until none is above. Sources clamp in the order of cap by weight, so one ordered pass over the sources
finds the level at which the rounds end. A document is then taken a whole number of times, and once more
where its seeded place lies in the fractional repetition of its source.

Only DataFrame functions are used. The documents are read twice and not shuffled; what is gathered is a
sum per source and one of 65,536 hash ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import WORD, fresh, keyed_bits, store

SEED = "mix-1"
MAX_EPOCHS = 3.0
RANGE_BITS = 16
_BITS = 60


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1)) -> DataFrame:
    """Weights dealt in turn to the sources in code point order, null last; a row per source is sorted."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    return sizes.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), place % len(weights) + 1))


def water_fill(sizes: DataFrame, share: float = 1.0, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to ``(source, source_size, weight)``, one row per source.

    Targets sum to ``share`` of all sizes unless every source is at its cap. Sources without weight
    (null, zero or less) or without size get 0.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(0.0))
    rows = sizes.withColumn("cap", cap.cast("double")).withColumn("w", weight.cast("double"))
    rows = rows.withColumn("total", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
    ordered = Window.orderBy(F.when(F.col("w") > 0, F.col("cap") / F.col("w")).asc_nulls_last(), "source")
    before = F.coalesce(F.sum("cap").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(ordered.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("before", before).withColumn("rest", rest)
    rows = rows.withColumn("clamped", (F.col("w") > 0) & (F.col("cap") * F.col("rest") <= (F.col("total") - F.col("before")) * F.col("w")))
    whole = Window.partitionBy()
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(whole), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("clamped"), F.col("w"))).over(whole)
    target = F.when(F.col("clamped"), F.col("cap")).when(F.col("w") > 0, left * F.col("w") / open_weight).otherwise(0.0)
    return rows.select("source", "source_size", "weight", target.alias("target"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weigh=cycled_weights,
    share: float = 1.0,
    max_epochs: float = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with a struct column ``mix`` of ``size, source_size, target, copies``.

    ``weigh`` adds ``weight`` to a row per source. ``copies`` is how often the document is taken: the
    whole repetitions of its source, and one more where it is among the first of the seeded order that
    fill the rest (the last one where at least half of it fits). Rows equal in id and text share a place
    and are taken alike. Null is a source of its own; texts without words have size 0 and follow their
    place; where a source has no words nothing is taken. The same rows give the same mix.
    """
    size = word_count(F.col(text))
    bits = keyed_bits(seed, F.col(doc_id), F.md5(F.coalesce(F.col(text), F.lit(""))))
    sized = store(docs.select(F.col(source).alias("source"), size.alias("size"), bits.alias("bits")), "mix-sizes")
    part = F.shiftright("bits", _BITS - RANGE_BITS).alias("part")
    ranges = store(sized.groupBy("source", part).agg(F.sum("size").alias("part_size")), "mix-ranges")
    sizes = ranges.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    plan = water_fill(weigh(sizes), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = store(plan, "mix-plan")
    filled = F.sum("part_size").over(Window.partitionBy("source").orderBy("part"))
    met = ranges.withColumn("filled", filled).join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    last = met.filter((F.col("need") > 0) & (F.col("filled") >= F.col("need"))).groupBy("source", "need").agg(
        F.min(F.struct("part", (F.col("filled") - F.col("part_size")).alias("below"))).alias("last")
    )
    last = store(last.select(F.col("source").alias("s"), "need", "last.part", "last.below"), "mix-last")
    same = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("bits", _BITS - RANGE_BITS) == F.col("part"))
    near = sized.join(last, same).groupBy("source", "part", "need", "below", "bits").agg(F.sum("size").alias("size"))
    run = F.col("below") + F.sum("size").over(Window.partitionBy("source").orderBy("bits"))
    near = near.withColumn("fits", 2 * run - F.col("size") <= 2 * F.col("need"))
    edge = near.groupBy("source", "part").agg(F.max(F.when(F.col("fits"), F.col("bits"))).alias("top"))
    edge = edge.select(F.col("source").alias("s"), F.coalesce("top", F.shiftleft("part", _BITS - RANGE_BITS) - 1).alias("top"))
    plan = plan.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.struct(
            F.col("source"), F.col("source_size"), F.col("target"), F.col("whole"), F.coalesce("top", F.lit(-1).cast("long")).alias("top")
        ).alias("plan")
    )
    plan = store(plan, "mix-plan")
    held, name = fresh(docs, "mix_plan"), fresh(docs, "mix_place")
    met = docs.withColumn(name, bits).join(
        plan.withColumnRenamed("plan", held), F.col(source).eqNullSafe(F.col(f"{held}.source"))
    )
    copies = F.col(f"{held}.whole") + (F.col(name) <= F.col(f"{held}.top")).cast("long")
    mixed = F.struct(
        size.alias("size"),
        F.col(f"{held}.source_size").alias("source_size"),
        F.col(f"{held}.target").alias("target"),
        copies.alias("copies"),
    )
    return met.select(*docs.columns, mixed.alias(fresh(docs, "mix")))


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as it is taken, with their columns as they were."""
    name, nth = fresh(docs, "mix"), fresh(docs, "mix_nth")
    taken = mix(docs, **settings).filter(F.col(f"{name}.copies") > 0)
    return taken.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{name}.copies")))).select(*docs.columns)
