"""Annotation analysis: flat annotation table, gene table, sites to extract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.operators import flatten, genes, sites
from varloom.params import Params


def parsed_records(records: DataFrame, params: Params) -> DataFrame:
    """Records with INFO columns and bare IDs; keys outside the schema are in the column ``params.info_rest``."""
    parsed = flatten.parse_info(records, params.info_schema, params.info_rest)
    return flatten.clean_ids(parsed, params.ann_prefix, params.list_prefix)


def alleles(records: DataFrame, params: Params) -> DataFrame:
    """One row per ALT of raw records."""
    return flatten.decompose_alleles(parsed_records(records, params), params.info_schema, params.mode)


def having(records: DataFrame, text: str) -> DataFrame:
    """Records with ``text`` anywhere in INFO: a cheap test ahead of parsing, never a final one."""
    return records.filter(F.col("INFO").contains(text))


def lof_and_nmd(records: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """LOF and NMD entries of raw records. Few records have any; only those are parsed."""

    def rows(key: str) -> DataFrame:
        raw = having(records, f"{key}=").select("CHROM", "POS", "ALT", "INFO")
        parsed = flatten.parse_info(raw, {key: params.info_schema[key]})
        return flatten.decompose_alleles(flatten.clean_ids(parsed, params.ann_prefix, params.list_prefix))

    return flatten.explode_lof(rows("LOF"), params.mode), flatten.explode_nmd(rows("NMD"), params.mode)


def annotation_rows(records: DataFrame, params: Params) -> DataFrame:
    """One row per allele and ANN entry, with LOF and NMD joined and gated; Debug kept."""
    raw = sites.sites_only(records).drop("ID", "FILTER")
    ann = flatten.explode_ann(alleles(raw, params), mode=params.mode)
    joined = flatten.join_counted_lof_nmd(ann, *lof_and_nmd(raw, params), params.lof_effects)
    return flatten.add_variant_type(flatten.blank_fields(joined))


def split_annotations(records: DataFrame, params: Params) -> DataFrame:
    """The flat annotation table: distinct rows, without the messages."""
    rows = annotation_rows(records, params)
    return flatten.distinct_annotations(rows.drop("ROW_ID", "ALT_IDX"))


def debug_messages(records: DataFrame, params: Params) -> DataFrame:
    """One row per annotation row and message; several LOF or NMD entries repeat the row."""
    raw = sites.sites_only(records)
    ann = flatten.explode_ann(alleles(raw, params), mode=params.mode).select(
        "CHROM", "POS", "REF", "ALT", "Effect", "Protein_ID", "Gene_ID", "Debug"
    )
    joined = flatten.join_lof_nmd(ann, *lof_and_nmd(raw, params))
    return flatten.parse_debug(joined).select(
        "CHROM", "POS", "REF", "ALT", "Effect", "Protein_ID", "Debug_Message", "Debug_Code"
    )


def gene_table(
    tables: dict[str, DataFrame], curated: DataFrame, gff: DataFrame, params: Params
) -> tuple[DataFrame, DataFrame]:
    """The proteins of interest and their annotated features."""
    ids = genes.proteins_of_interest(tables, curated, params.search_terms)
    kept = {source: genes.keep_proteins(table, ids, "proteinId") for source, table in tables.items()}
    proteins = genes.full_join_annotations(kept["GO"], kept["IPR"], kept["KEGG"], kept["KOG"])
    features = genes.fill_gene_ids(genes.gff_features(gff))
    table = genes.gene_annotations(proteins, features)
    return ids, genes.annotate_override(table, params.product_overrides)


def high_impact_sites(records: DataFrame, ids: DataFrame, table: DataFrame, params: Params) -> DataFrame:
    """Distinct sites of high-impact variants inside genes of interest.

    LOF, NMD and repeated rows do not change which sites these are, so they are not computed. The rows that
    remain are narrow: they are shuffled, as the tables of genes are too large for the driver long before
    their files look so.
    """
    raw = having(sites.sites_only(records), f"|{params.impact}|")
    rows = flatten.explode_ann(alleles(raw, params), mode=params.mode)
    high = rows.filter(F.col("Impact") == params.impact).select("CHROM", "POS", "Protein_ID", "Gene_ID")
    kept = genes.keep_proteins(high, ids.hint("merge"))
    return sites.site_list(genes.variants_in_genes(kept, table.hint("merge")))
