"""Summary tables of annotation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.functions.text import blank_to_null, comma_number, percent
from varloom.operators.flatten import explode_effects

BOX_METRICS = ["AF", "QUAL", "DP", "QD", "AC"]


def row_totals(df: DataFrame) -> DataFrame:
    """One row: the number of rows, plain and with thousands separators."""
    return df.agg(F.count("*").alias("n")).withColumn("label", F.concat(F.lit("n = "), comma_number(F.col("n"))))


def effect_counts(annotations: DataFrame) -> DataFrame:
    """Rows per effect, most frequent first."""
    counts = explode_effects(annotations).groupBy("Effect").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "Effect")


def impact_distribution(annotations: DataFrame) -> DataFrame:
    """Rows per impact, their share of all rows, and the label that shows both."""
    counts = annotations.groupBy("Impact").agg(F.count("*").alias("n"))
    # One row per impact is left here.
    share = percent(F.col("n"), F.sum("n").over(Window.partitionBy()))
    counts = counts.withColumn("pct", share)
    shown = F.regexp_replace(F.col("pct").cast("decimal(20,2)").cast("string"), r"\.?0+$", "")
    label = F.concat(comma_number(F.col("n")), F.lit(" ("), shown, F.lit("%)"))
    return counts.withColumn("label", label)


def type_effect_impact(annotations: DataFrame) -> DataFrame:
    """Rows per variant type, effect and impact."""
    counts = explode_effects(annotations).groupBy("Variant_Type", "Effect", "Impact").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "Variant_Type", "Effect", "Impact")


def debug_counts(messages: DataFrame) -> DataFrame:
    """Messages per text and effect; rows without a code or a text are left out."""
    told = messages.filter(
        F.col("Debug_Code").isNotNull() & blank_to_null(F.col("Debug_Message")).isNotNull()
    )
    counts = explode_effects(told).groupBy("Debug_Message", "Effect").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "Debug_Message", "Effect")


def label_threshold(counts: DataFrame, p: float = 0.4) -> DataFrame:
    """One row: the ``p`` quantile of the group counts; smaller groups get a label."""
    return counts.agg(F.percentile("n", F.lit(p)).alias("threshold"))


def box_stats(rows: DataFrame, by: str, metrics: list[str] = BOX_METRICS, buckets: int = 200) -> DataFrame:
    """Quartiles and whisker ends of each metric per value of ``by``.

    Quartiles are exact and interpolate linearly; whiskers end at the last value within 1.5 times
    the interquartile range. A group may hold any number of rows and of different values: equal
    values are counted first, and the running count that finds a rank runs inside buckets of
    the value range, so no task sees a whole group.
    """
    group = [by, "Metric"]
    pairs = [F.struct(F.lit(m).alias("Metric"), F.col(m).cast("double").alias("Value")) for m in metrics]
    values = rows.select(by, F.inline(F.array(*pairs))).filter(F.col("Value").isNotNull())
    counts = values.groupBy(*group, "Value").agg(F.count("*").alias("_n"))

    # Bucket edges only share out the work: any edges give the same result.
    steps = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    edges = counts.groupBy(*group).agg(
        F.percentile_approx("Value", steps, 10000).alias("_edges"), F.sum("_n").alias("_total")
    )
    placed = counts.join(edges, group).withColumn(
        "_bucket", F.size(F.filter("_edges", lambda edge: edge < F.col("Value")))
    )
    placed = placed.drop("_edges")
    sizes = placed.groupBy(*group, "_bucket").agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_bucket").orderBy("Value")
    ranked = placed.join(sizes, [*group, "_bucket"]).withColumn(
        "_upto", F.col("_offset") + F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )

    def value_at(p: float, rounding) -> Column:
        rank = rounding((F.col("_total") - 1) * p)
        return F.min(F.when(F.col("_upto") > rank, F.col("Value")))

    quartiles = {"q1": 0.25, "med": 0.5, "q3": 0.75}
    found = ranked.groupBy(*group).agg(
        F.max("_total").alias("n"),
        *[value_at(p, F.floor).alias(f"_{q}_low") for q, p in quartiles.items()],
        *[value_at(p, F.ceil).alias(f"_{q}_high") for q, p in quartiles.items()],
    )

    def between(q: str, p: float) -> Column:
        at = (F.col("n") - 1) * p
        return F.col(f"_{q}_low") + (at - F.floor(at)) * (F.col(f"_{q}_high") - F.col(f"_{q}_low"))

    boxes = found.select(*group, "n", *[between(q, p).alias(q) for q, p in quartiles.items()])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    ends = (
        counts.join(boxes, group)
        .filter(F.col("Value").between(F.col("q1") - reach, F.col("q3") + reach))
        .groupBy(*group)
        .agg(F.min("Value").alias("_lo"), F.max("Value").alias("_hi"))
    )
    return boxes.join(ends, group).select(
        *group,
        "n",
        "q1",
        "med",
        "q3",
        F.least("q1", "_lo").alias("lo"),
        F.greatest("q3", "_hi").alias("hi"),
    )


#: Size of a quantile sketch; its rank error falls nearly with its inverse.
SKETCH_K = 4096


def rank_error(k: int = SKETCH_K) -> float:
    """How far, as a share of all rows, the rank of a sketched quantile may be off, at 99 % confidence."""
    return 2.296 / k**0.9021


def box_sketches(rows: DataFrame, by: str, metrics: list[str] = BOX_METRICS, k: int = SKETCH_K) -> DataFrame:
    """What :func:`boxes_of_sketches` needs of ``rows``: per value of ``by`` and metric a sketch, of bounded size.

    Sketches of parts of a table merge, so they are kept with each stored part and never built again.
    """
    pairs = [F.struct(F.lit(m).alias("Metric"), F.col(m).cast("double").alias("Value")) for m in metrics]
    values = rows.select(by, F.inline(F.array(*pairs))).filter(F.col("Value").isNotNull() & ~F.isnan("Value"))
    return values.groupBy(by, "Metric").agg(
        F.kll_sketch_agg_double("Value", F.lit(k)).alias("sketch"), F.count("*").alias("n"), F.min("Value").alias("least"), F.max("Value").alias("most")
    )


def boxes_of_sketches(sketches: DataFrame, by: str) -> DataFrame:
    """Quartiles and ends per value of ``by`` and metric, from sketches of any number of parts.

    The rank of a quartile is off by :func:`rank_error` at most; :func:`box_stats` is exact. ``n``, ``least``
    and ``most`` are exact here too.
    """
    merged = sketches.groupBy(by, "Metric").agg(
        F.kll_merge_agg_double("sketch").alias("_sketch"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")
    )
    quartiles = [F.kll_sketch_get_quantile_double("_sketch", F.lit(p)).alias(q) for q, p in (("q1", 0.25), ("med", 0.5), ("q3", 0.75))]
    return merged.select(by, "Metric", "n", "least", *quartiles, "most")
