"""Scores and rank order of variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions import scoring
from varloom.params import EFFECT_SEVERITY, TERM_RANK


def effect_severity(variants: DataFrame, severity: dict[str, int] = EFFECT_SEVERITY) -> DataFrame:
    """Add ``Effect_Rank``."""
    return variants.withColumn("Effect_Rank", scoring.effect_rank(F.col("Effect"), severity))


def merge_annotations(variants: DataFrame) -> DataFrame:
    """Add ``Annotations``, the merged text of all annotation columns."""
    texts = [F.col(c) for c in ("IPR", "KEGG", "GO", "KOG", "Protein_Product")]
    return variants.withColumn("Annotations", scoring.merge_annotations(*texts))


def term_rank(variants: DataFrame, ranks: dict[str, int] = TERM_RANK) -> DataFrame:
    """Add ``Matched_Terms`` and ``Annot_Rank``."""
    text = F.col("Annotations")
    return variants.withColumns(
        {"Matched_Terms": scoring.matched_terms(text, ranks), "Annot_Rank": scoring.annotation_rank(text, ranks)}
    )


def combined_rank(variants: DataFrame) -> DataFrame:
    """Add ``Comb_Rank``."""
    return variants.withColumn("Comb_Rank", F.col("Effect_Rank") + F.col("Annot_Rank"))


def rank_keys() -> list[Column]:
    """Rank, allele frequency and number of alleles, then the place in the file and, last, what rows of one entry differ in."""
    keys = ["Comb_Rank", "AF", "N_ALT_ALLELES", "ROW_ID", "ALT_IDX", "ANN_IDX"]
    keys += ["Total_Transcripts_LOF", "Percent_Transcripts_LOF", "Total_Transcripts_NMD", "Percent_Transcripts_NMD", "ID"]
    return [F.col(c).asc_nulls_last() for c in keys]


def rank_order(variants: DataFrame) -> DataFrame:
    """Sort by :func:`rank_keys`."""
    return variants.orderBy(*rank_keys())
