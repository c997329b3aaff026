"""Classes of linked nodes, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import store


def _edges(pairs: DataFrame) -> DataFrame:
    ends = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return store(ends.filter("a != b").distinct(), "links")


def connected(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``; the label is the smallest node of its class.

    Links are contracted: every node goes to its smallest neighbour if that is smaller, two such steps at
    once, and links between what is left are linked again. So the number of rounds grows with the
    logarithm of a class, chains included, and links shrink from round to round. Rounds are written
    tables. A node may have any number of links: minima combine before the shuffle.
    """
    edges = _edges(links)
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = nodes.select("node", F.col("node").alias("label"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        near = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("from"), F.least("a", "low").alias("to"))
        near = store(near, "nearest")
        onward = near.select(F.col("from").alias("to"), F.col("to").alias("far"))
        step = store(near.join(onward, "to").select("from", F.col("far").alias("to")), "nearest")
        moved = labels.join(step, labels.label == step["from"], "left")
        labels = store(moved.select("node", F.coalesce("to", "label").alias("label")), "labels")
        a = step.select(F.col("from").alias("a"), F.col("to").alias("new_a"))
        b = step.select(F.col("from").alias("b"), F.col("to").alias("new_b"))
        edges = _edges(edges.join(a, "a").join(b, "b").select(F.col("new_a").alias("a"), F.col("new_b").alias("b")))
    return labels
