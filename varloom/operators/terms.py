"""Texts that hold any of a table of terms, of any size, by an index of their short pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of a piece. Shorter terms are pieces themselves.
PIECE = 3


def _pieces(text: Column, size: int) -> Column:
    """Distinct pieces of ``size`` characters of a text; none where it is shorter."""
    places = F.sequence(F.lit(1), F.length(text) - (size - 1))
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(places, lambda at: F.substring(text, at, size))))


def matches(texts: DataFrame, terms: DataFrame, key: list[str], text: str, term: str = "term") -> DataFrame:
    """``key, term`` of every text that holds a term, ignoring case, once each; empty and missing terms match nothing.

    Each term is looked for by one of its pieces, the one that the fewest texts have; only texts with that
    piece are searched for the term. Texts meet terms by piece, so neither table has to be small, and a
    term costs what its rarest piece does.
    """
    wanted = terms.select(F.col(term).alias("_term")).filter(F.length("_term") > 0).distinct().withColumn("_low", F.lower("_term"))
    size = F.least(F.length("_low"), F.lit(PIECE))
    sizes = [r[0] for r in wanted.select(size).distinct().collect()]  # 1 to PIECE
    of_size = F.coalesce(*[F.when(size == n, _pieces(F.col("_low"), n)) for n in sizes or [PIECE]])
    of_terms = wanted.select("_term", "_low", F.explode(of_size).alias("_piece"))
    kept = texts.select(*key, F.col(text).alias("_text")).withColumn("_text", F.lower("_text"))
    every = F.flatten(F.array(*[F.coalesce(_pieces(F.col("_text"), n), F.array().cast("array<string>")) for n in sizes or [PIECE]]))
    rows = kept.select(*key, "_text", F.explode(every).alias("_piece")).join(of_terms.select("_piece").distinct(), "_piece", "left_semi")
    counts = rows.groupBy("_piece").agg(F.count("*").alias("_n"))
    # A piece of a term that no text has settles that the term is nowhere.
    rarest = of_terms.join(counts, "_piece", "left").groupBy("_term", "_low").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_piece").alias("piece"))).alias("_rare"))
    asked = rarest.filter("_rare.n > 0").select("_term", "_low", F.col("_rare.piece").alias("_piece"))
    found = rows.join(asked, "_piece").filter(F.contains("_text", F.col("_low")))
    return found.select(*key, F.col("_term").alias(term)).distinct()
