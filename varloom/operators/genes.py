"""Gene features, gene-function tables and their joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.functions.scoring import any_of
from varloom.functions.text import reloaded
from varloom.operators.order import fill_down_up, ordered_text
from varloom.params import NAME_COLUMNS, SEARCH_TERMS

FILLED = ["Protein_ID", "Transcript_ID", "Protein_Product"]
TEXT_COLUMNS = ["GO", "IPR", "KEGG", "KOG", "Protein_Product"]

# Rows of one gene that one task orders at a time when filling.
FILL_CHUNK = 1 << 17
# Lines of a table whose names are joined at a time for one protein.
COLLAPSE_CHUNK = 1 << 12


def gff_features(gff: DataFrame) -> DataFrame:
    """Widen the attributes of a feature scan and derive ``Gene_ID`` from the parent.

    ``Start`` and ``End`` become ``feature_start`` and ``feature_end``, as INFO has an END too.
    """
    rows = gff.withColumn("_attr", F.str_to_map("Attributes", F.lit(";"), F.lit("=")))

    def attribute(key: str):
        return F.try_element_at("_attr", F.lit(key))

    parent = F.coalesce(attribute("Parent"), attribute("ID"))
    gene = F.coalesce(F.get(F.split(parent, "_"), F.lit(1)), F.lit("NA"))
    return rows.select(
        "_row",
        "CHROM",
        "Type",
        F.col("Start").alias("feature_start"),
        F.col("End").alias("feature_end"),
        "Strand",
        "Phase",
        attribute("ID").alias("ID"),
        attribute("proteinId").alias("Protein_ID"),
        attribute("transcriptId").alias("Transcript_ID"),
        parent.alias("Parent"),
        F.concat(F.lit("gene_"), gene).alias("Gene_ID"),
        attribute("product_name").alias("Protein_Product"),
    )


def fill_gene_ids(features: DataFrame, chunk_rows: int = FILL_CHUNK) -> DataFrame:
    """Give every feature of a gene its protein, transcript and product: down, then up, file order.

    Features without a gene all share the ID ``gene_NA``; the fill is chunked for such groups.
    """
    chunk = F.floor(F.col("_row") / chunk_rows)
    return fill_down_up(features, "Gene_ID", "_row", FILLED, chunk)


def collapse_annotations(table: DataFrame, source: str, chunk_rows: int = COLLAPSE_CHUNK) -> DataFrame:
    """One row per protein: its names joined with ``;`` in file order, repeats kept.

    GO shows a missing name as ``NA``; the other tables leave it out, so that a protein with
    missing names only gets empty text. Names are joined in chunks of ``chunk_rows`` lines of the table, so
    that no task gathers those of a protein one by one.
    """
    return _collapse([(source, table)], chunk_rows)


def _named(source: str, table: DataFrame) -> DataFrame:
    name = F.col(NAME_COLUMNS[source])
    if source == "GO":
        name = F.coalesce(name, F.lit("NA"))
    return table.select(
        F.lit(source).alias("_source"), F.col("proteinId").cast("string").alias("Protein_ID"), "_row", name.alias("_name")
    )


def _collapse(tables: list[tuple[str, DataFrame]], chunk_rows: int = COLLAPSE_CHUNK) -> DataFrame:
    rows = None
    for source, table in tables:
        part = _named(source, table)
        rows = part if rows is None else rows.unionByName(part)
    chunk = F.floor(F.col("_row") / chunk_rows)
    texts = ordered_text(rows, ["Protein_ID", "_source"], ["_row"], {"_names": F.col("_name")}, ";", chunk)
    one = {source: F.max(F.when(F.col("_source") == source, F.col("_names"))).alias(source) for source, _ in tables}
    return texts.groupBy("Protein_ID").agg(*one.values())


def full_join_annotations(go: DataFrame, ipr: DataFrame, kegg: DataFrame, kog: DataFrame) -> DataFrame:
    """One row per protein of any table, with the collapsed text of each: GO, IPR, KEGG, KOG.

    Equals a chain of full outer joins of the collapsed tables; the tables are stacked and grouped
    together instead.
    """
    return _collapse([("GO", go), ("IPR", ipr), ("KEGG", kegg), ("KOG", kog)])


def search_terms(table: DataFrame, source: str, terms: list[str] | tuple = SEARCH_TERMS) -> DataFrame:
    """Distinct proteins with a name that holds any term, ignoring case.

    No term holds the separator of the collapsed text, so the rows can be searched one by one
    before anything is shuffled.
    """
    if any(";" in term for term in terms):
        raise ValueError("a search term must not hold ';'")
    hits = table.filter(any_of(F.col(NAME_COLUMNS[source]), terms, ignore_case=True))
    return hits.select(F.col("proteinId").cast("string").alias("Protein_ID")).distinct()


def proteins_of_interest(
    tables: dict[str, DataFrame], curated: DataFrame, terms: list[str] | tuple = SEARCH_TERMS
) -> DataFrame:
    """Distinct proteins found by term in any table, and those of the curated list."""
    ids = curated.select(F.col("Protein Id").cast("string").alias("Protein_ID"))
    for source, table in tables.items():
        ids = ids.unionByName(search_terms(table, source, terms))
    return ids.distinct()


def keep_proteins(df: DataFrame, ids: DataFrame, column: str = "Protein_ID") -> DataFrame:
    """Rows whose protein is in ``ids``."""
    return df.join(ids, df[column].cast("string") == ids["Protein_ID"], "left_semi")


def annotate_override(genes: DataFrame, overrides: dict[str, str]) -> DataFrame:
    """Append text to the product of single proteins; a missing product shows as ``NA``."""
    product = F.col("Protein_Product")
    patched = product
    for protein, text in overrides.items():
        added = F.concat_ws(";", F.coalesce(product, F.lit("NA")), F.lit(text))
        patched = F.when(F.col("Protein_ID").try_cast("bigint") == int(protein), added).otherwise(patched)
    return genes.withColumn("Protein_Product", patched)


def gene_annotations(proteins: DataFrame, features: DataFrame) -> DataFrame:
    """Join proteins to their features, leaving out mRNA, which repeats the gene.

    Proteins without a feature have no type and are left out as well.
    """
    return proteins.join(features.filter(F.col("Type") != "mRNA"), "Protein_ID").select(
        "Protein_ID",
        "GO",
        "IPR",
        "KEGG",
        "KOG",
        "CHROM",
        "Type",
        "feature_start",
        "feature_end",
        "Strand",
        "Phase",
        "ID",
        "Transcript_ID",
        "Parent",
        "Gene_ID",
        "Protein_Product",
    )


def variants_in_genes(annotations: DataFrame, genes: DataFrame) -> DataFrame:
    """Annotation rows joined to the features of their gene that span the position.

    The gene side is broadcast when its size allows; beyond that both sides are shuffled by gene
    and a hot gene is split.
    """
    keys = ["CHROM", "Protein_ID", "Gene_ID"]
    joined = annotations.join(genes, keys)
    return joined.filter(F.col("POS").between(F.col("feature_start"), F.col("feature_end")))


def annotate_variants(variants: DataFrame, genes: DataFrame) -> DataFrame:
    """Left join of the gene rows' annotations.

    Texts are taken as they read back from the stored table, where empty and ``NA`` are missing.
    """
    rows = genes.filter(F.col("Type") == "gene")
    rows = rows.withColumns({c: reloaded(F.col(c)) for c in TEXT_COLUMNS})
    return variants.join(rows, ["CHROM", "Protein_ID", "Gene_ID"], "left")
