"""A whole study, from text inputs to the written reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from varloom.operators import crosses as X
from varloom.operators import flatten
from varloom.params import Params
from varloom.plans import annotations, crosses
from varloom.session import configure, new_path
from varloom.sources import store, tables, vcf


@dataclass(frozen=True)
class Files:
    """Where the inputs of a study are: an annotated VCF with genotypes, and the tables around it."""

    vcf: str
    gff: str
    tables: str
    tables_prefix: str
    curated: str
    metadata: str
    metadata_schema: str = "SampleID bigint, GametophyteCode string"


def run_study(spark: SparkSession, files: Files, out: str, params: Params) -> dict[str, str]:
    """Write every report below ``out`` and return their paths.

    Steps hand over stored tables, in the order of the study: samples, genes, annotations, listed sites,
    the records there, their ranked variants, and crosses. With ``mode="permissive"`` malformed records
    are written to ``bad_records``; otherwise the first of them ends the job.
    """
    configure(spark)
    paths: dict[str, str] = {}

    def report(name: str, df: DataFrame, header: bool = True) -> None:
        paths[name] = f"{out}/{name}"
        tables.write_tsv(store.report_names(df), paths[name], header=header)

    def stage(name: str, df: DataFrame) -> DataFrame:
        return store.stage(spark, new_path(spark, name), lambda: df)

    header = vcf.vcf_header(spark, files.vcf)
    names = vcf.vcf_samples(spark, files.vcf)
    records = stage("records", vcf.read_vcf(spark, files.vcf))
    samples = stage("samples", X.sample_index(tables.read_csv(spark, files.metadata, files.metadata_schema)))
    report("sample_index", samples)
    report("sample_id_check", X.sample_id_check(samples.select("SampleID", "GametophyteCode"), names.select("SampleID")))

    found = tables.discover_annotation_tables(spark, files.tables, files.tables_prefix)
    ids, genes = annotations.gene_table(found, tables.read_csv(spark, files.curated), tables.read_gff(spark, files.gff), params)
    ids, genes = stage("ids", ids), stage("genes", genes)
    report("proteins", ids, header=False)
    report("genes", genes)

    if params.mode == "permissive":
        parsed = annotations.parsed_records(records, params)
        report("bad_records", flatten.bad_records(parsed, params.info_schema).select("ROW_ID", "CHROM", "POS", "Reason"))
    report("split_annotations", annotations.split_annotations(records, params))
    report("debug_messages", annotations.debug_messages(records, params))

    listed = stage("sites", annotations.high_impact_sites(records, ids, genes, params))
    report("sites", listed, header=False)
    subset = crosses.store_subset(records, listed)
    paths["subset_vcf"] = f"{out}/subset_vcf"
    vcf.write_vcf(subset.orderBy("ROW_ID"), header, paths["subset_vcf"])

    ranked = stage("ranked", crosses.rank_variants(crosses.high_calls(subset, params), genes, params, ordered=False))
    report("ranked_variants", ranked.drop("CELLS", "FORMAT"))
    table = stage("cross-table", crosses.cross_table(ranked, names, samples, params))
    report("cross_table", table.drop("Cross_Order"))
    report("cross_list", X.cross_list(table))
    return paths
