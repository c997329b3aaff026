"""Filters and tallies of whole records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions.alleles import allele_class, is_transition, substitution
from varloom.operators import intervals
from varloom.params import VCF_FIXED

def sites_only(records: DataFrame) -> DataFrame:
    """Drop the genotypes."""
    return records.select([c for c in records.columns if c in (*VCF_FIXED, "ROW_ID")])


def site_list(annotations: DataFrame) -> DataFrame:
    """Distinct (CHROM, POS)."""
    return annotations.select("CHROM", "POS").distinct()


def filter_ann_gene(records: DataFrame, genes: list[str] | DataFrame) -> DataFrame:
    """Records with an ANN entry on one of ``genes``: IDs, or a DataFrame with ``Gene_ID``.

    Takes records whose ANN prefix is cleaned.
    """
    if not isinstance(genes, DataFrame):
        wanted = "|".join(re.escape(gene) for gene in genes)
        return records.filter(F.col("ANN").rlike(rf"(?:^|,)(?:[^|,]*\|){{4}}(?:{wanted})\|"))
    own = F.transform(F.split("ANN", ","), lambda e: F.get(F.split(e, "\\|"), F.lit(4)))
    rows = records.select("ROW_ID", F.explode(F.array_distinct(own)).alias("Gene_ID"))
    hits = rows.join(genes.select("Gene_ID").distinct(), "Gene_ID", "left_semi")
    return records.join(hits.select("ROW_ID"), "ROW_ID", "left_semi")


def filter_lof_nmd(records: DataFrame) -> DataFrame:
    """Records with a LOF or an NMD entry."""
    return records.filter((F.coalesce("LOF", F.lit("")) != "") | (F.coalesce("NMD", F.lit("")) != ""))


def allele_classes(records: DataFrame) -> DataFrame:
    """Add ``Classes``, the class of each ALT."""
    return records.withColumn(
        "Classes", F.transform(F.split("ALT", ","), lambda alt: allele_class(F.col("REF"), alt))
    )


def multiallelic(records: DataFrame, kind: str, require: str = "all") -> DataFrame:
    """Records with several ALTs of class ``kind`` (``snp``, ``indel``, ...); ``any`` asks for one."""
    rows = allele_classes(records.filter(F.size(F.split("ALT", ",")) > 1))
    test = F.forall if require == "all" else F.exists
    return rows.filter(test("Classes", lambda c: c == kind)).drop("Classes")


def span_end(records: DataFrame) -> Column:
    """Last position of each record: that of its REF, or INFO ``END`` where that is further."""
    last = F.col("POS") + F.length("REF") - 1
    if "END" in records.columns:
        return F.greatest(last, F.col("END").cast("bigint"))
    if "INFO" in records.columns:
        # Few records have one.
        stated = F.when(F.contains("INFO", F.lit("END=")), F.regexp_extract("INFO", "(?:^|;)END=([0-9]+)(?=;|$)", 1))
        return F.greatest(last, stated.try_cast("bigint"))
    return last


def subset_sites(records: DataFrame, sites: DataFrame, mode: str = "overlap") -> DataFrame:
    """Records that cover a listed (CHROM, POS); with mode ``pos``, records that begin there.

    A record covers its REF, or what INFO ``END`` says. Spans of any length meet the list in one or two
    bins each, see :mod:`varloom.operators.intervals`. Only numbers of records go through that join; the
    records are then found by their own site and number, so a layout by site needs no shuffle.
    """
    wanted = sites.select("CHROM", F.col("POS").cast("bigint").alias("POS"))
    if mode == "pos":
        return records.join(wanted, ["CHROM", "POS"], "left_semi")
    spans = records.select("ROW_ID", "CHROM", "POS", span_end(records).alias("_last"))
    hits = intervals.covering(spans, wanted.withColumnRenamed("POS", "_listed"), "CHROM", "POS", "_last", "_listed")
    return records.join(hits.select("CHROM", "POS", "ROW_ID"), ["CHROM", "POS", "ROW_ID"], "left_semi")


def _n_samples(header_samples: DataFrame | None) -> Column:
    """Aggregate: the samples that the header names; none without one. Genotypes are not read."""
    counted = F.lit(0) if header_samples is None else header_samples.agg(F.count("*")).scalar()
    return F.max(counted).cast("bigint")


def variant_counts(records: DataFrame, header_samples: DataFrame | None = None) -> DataFrame:
    """One row: samples, sites, and sites with a SNP, an indel, an MNP and any other allele."""
    rows = allele_classes(records)

    def having(kind: str) -> Column:
        return F.count_if(F.array_contains("Classes", kind))

    return rows.agg(
        _n_samples(header_samples).alias("n_samples"),
        having("snp").alias("n_snps"),
        having("indel").alias("n_indels"),
        having("mnp").alias("n_mnps"),
        having("other").alias("n_others"),
        F.count("*").alias("n_sites"),
    )


def variant_stats(records: DataFrame, header_samples: DataFrame | None = None) -> DataFrame:
    """Whole-file totals as rows of (Section, n)."""
    rows = allele_classes(records).withColumn("_alts", F.size(F.split("ALT", ",")))

    def having(kind: str) -> Column:
        return F.count_if(F.array_contains("Classes", kind))

    many = F.col("_alts") > 1
    totals = rows.agg(
        _n_samples(header_samples).alias("samples"),
        F.count("*").alias("records"),
        F.count_if(F.col("ALT") == ".").alias("no-ALTs"),
        having("snp").alias("SNPs"),
        having("mnp").alias("MNPs"),
        having("indel").alias("indels"),
        having("other").alias("others"),
        F.count_if(many).alias("multiallelic sites"),
        F.count_if(many & F.forall("Classes", lambda c: c == "snp")).alias("multiallelic SNP sites"),
    )
    return totals.unpivot([], totals.columns, "Section", "n")


def ts_tv(alleles: DataFrame) -> DataFrame:
    """One row: transitions, transversions and their ratio, over single-base alleles."""
    rows = alleles.withColumn("_ts", is_transition(F.col("REF"), F.col("ALT")))
    counts = rows.agg(F.count_if(F.col("_ts")).alias("ts"), F.count_if(~F.col("_ts")).alias("tv"))
    return counts.withColumn("ts_tv", F.round(F.col("ts") / F.nullif(F.col("tv"), F.lit(0)), 2))


def substitution_counts(alleles: DataFrame) -> DataFrame:
    """Count of each single-base change."""
    rows = alleles.withColumn("Change", substitution(F.col("REF"), F.col("ALT")))
    return rows.filter(F.col("Change").isNotNull()).groupBy("Change").agg(F.count("*").alias("n"))


def indel_lengths(alleles: DataFrame) -> DataFrame:
    """Count of each indel length; deletions are negative."""
    rows = alleles.filter(allele_class(F.col("REF"), F.col("ALT")) == "indel")
    size = F.length("ALT") - F.length("REF")
    return rows.groupBy(size.alias("Length")).agg(F.count("*").alias("n"))


def quality_histogram(records: DataFrame) -> DataFrame:
    """Records, and records with a SNP and with an indel, per whole QUAL."""
    rows = allele_classes(records)
    return rows.groupBy(F.floor("QUAL").cast("bigint").alias("Quality")).agg(
        F.count("*").alias("n"),
        F.count_if(F.array_contains("Classes", "snp")).alias("n_snps"),
        F.count_if(F.array_contains("Classes", "indel")).alias("n_indels"),
    )


def depth_histogram(records: DataFrame, calls: DataFrame | None = None) -> DataFrame:
    """Records per depth (DP) and, with long ``calls``, genotypes per depth (DP_S)."""
    depths = records.select(F.col("DP").alias("Depth"), F.lit(1).alias("_site"), F.lit(0).alias("_call"))
    if calls is not None:
        depths = depths.unionByName(
            calls.select(F.col("DP_S").alias("Depth"), F.lit(0).alias("_site"), F.lit(1).alias("_call"))
        )
    return (
        depths.filter(F.col("Depth").isNotNull())
        .groupBy("Depth")
        .agg(F.sum("_site").alias("n_sites"), F.sum("_call").alias("n_genotypes"))
    )


def sample_rows(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """The rows whose key hashes into the lowest ``fraction``: the same rows on every run and layout.

    A filter on the key alone: no count, no sort, and rows of one key stay together.
    """
    drawn = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(key))), 1, 8), 16, 10).cast("bigint")
    return df.filter(drawn < round(fraction * 2**32))
