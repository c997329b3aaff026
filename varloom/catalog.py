"""The registered queries: every operator and pipeline over whole derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.fixtures import ANN_PREFIX, LIST_PREFIX, STUDY, Inputs
from varloom.operators import calls as C
from varloom.operators import crosses as X
from varloom.operators import flatten as L
from varloom.operators import genes as G
from varloom.operators import intervals, order, terms
from varloom.operators import qc as Q
from varloom.operators import ranking as R
from varloom.operators import sites as S
from varloom.plans import annotations as PA
from varloom.plans import crosses as PX
from varloom.session import new_path
from varloom.sources import blocks, store, tables, vcf
from varloom.streaming import tallies
from varloom.functions.text import pretty_label

Query = Callable[[Inputs], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name -> callable of a session and a folder of tables."""

    def bound(run: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: run(Inputs(spark, sf_dir))

    return {name: bound(run) for name, run in _QUERIES.items()}


# Columns the annotation queries show; the others are constant in the derived data.
ALLELE = ["CHROM", "POS", "REF", "ALT"]
INFO = ["QUAL", "AC", "AF", "AN", "DP", "DS", "QD", "RAW_MQandDP"]
ENTRY = ["Effect", "Impact", "Protein_ID", "Gene_ID", "HGVS_c", "HGVS_p", "Dist_to_Feature"]
LOSS = [
    "LOF",
    "Total_Transcripts_LOF",
    "Percent_Transcripts_LOF",
    "NMD",
    "Total_Transcripts_NMD",
    "Percent_Transcripts_NMD",
]


def _sites(i: Inputs) -> DataFrame:
    return S.sites_only(i.vcf())


def _parsed(i: Inputs) -> DataFrame:
    return PA.parsed_records(_sites(i), STUDY)


def _alleles(i: Inputs) -> DataFrame:
    return PA.alleles(_sites(i), STUDY)


def _annotations(i: Inputs) -> DataFrame:
    return L.explode_ann(_alleles(i))


def _gene_table(i: Inputs) -> tuple[DataFrame, DataFrame]:
    return PA.gene_table(i.annotation_tables(), i.curated(), i.gff(), STUDY)


def _samples(i: Inputs) -> DataFrame:
    return X.sample_index(i.samples())


def _ranked(i: Inputs, ordered: bool = False) -> DataFrame:
    return PX.rank_variants(PX.calls_at(i.vcf(), _stored_sites(i), STUDY), _stored_genes(i), STUDY, ordered)


# Stages hand their result over as a stored table. Queries named after a pipeline compute it from
# the inputs; those on a single step of it start from the stored stage before.


def _stored_ids(i: Inputs) -> DataFrame:
    return i.stored("proteins_of_interest", lambda: _gene_table(i)[0])


def _stored_genes(i: Inputs) -> DataFrame:
    return i.stored("gene_annotations", lambda: _gene_table(i)[1])


def _stored_split(i: Inputs) -> DataFrame:
    return i.stored("split_annotations", lambda: PA.split_annotations(i.vcf(), STUDY))


def _stored_sites(i: Inputs) -> DataFrame:
    return i.stored("site_list", lambda: PA.high_impact_sites(i.vcf(), _stored_ids(i), _stored_genes(i), STUDY))


def _stored_ranked(i: Inputs) -> DataFrame:
    return i.stored("ranked", lambda: _ranked(i))


# ---- scans, sinks, stored stages ---------------------------------------------------------------


def _header(i: Inputs) -> DataFrame:
    """Header lines of the derived VCF, in order, from the sample table."""
    names = i.header_samples().agg(F.array_sort(F.collect_list(F.struct("SAMPLE_POS", "SampleID")))["SampleID"].alias("ids"))
    fixed = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"])
    lines = F.array(
        F.lit("##fileformat=VCFv4.2"),
        F.lit('##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">'),
        F.concat(F.lit(fixed + "\t"), F.array_join("ids", "\t")),
    )
    return names.select(F.explode(lines).alias("value"))


def _vcf_text(i: Inputs, compression: str = "none") -> str:
    path = new_path(i.spark, "vcf-text")
    vcf.write_vcf(i.vcf(), _header(i), path, compression)
    return path


@_query
def scan_vcf(i: Inputs) -> DataFrame:
    rows = vcf.read_vcf(i.spark, _vcf_text(i))
    return rows.select("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", F.array_join("CELLS", " ").alias("cells"))


@_query
def scan_vcf_gz(i: Inputs) -> DataFrame:
    rows = vcf.read_vcf(i.spark, _vcf_text(i, "gzip"), genotypes=False, spread=True)
    return rows.select("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "INFO")


@_query
def scan_vcf_blocks(i: Inputs) -> DataFrame:
    """Records of a block-compressed file, read by ranges, in the order of its lines."""
    path = new_path(i.spark, "vcf-blocks")
    lines = vcf.to_lines(i.vcf().orderBy("ROW_ID"))
    blocks.write_block_lines(lines, path)
    rows = vcf.read_vcf(i.spark, path, genotypes=False, blocks=True)
    return rows.select(F.col("ROW_ID").alias("row_no"), "CHROM", "POS", "ID", "REF", "ALT", "QUAL", "INFO")


@_query
def vcf_header(i: Inputs) -> DataFrame:
    return vcf.vcf_header(i.spark, _vcf_text(i))


@_query
def vcf_samples(i: Inputs) -> DataFrame:
    return vcf.vcf_samples(i.spark, _vcf_text(i))


@_query
def scan_gff(i: Inputs) -> DataFrame:
    """Features of a file, with their line."""
    path = new_path(i.spark, "gff-text")
    i.gff().orderBy("_row").drop("_row").write.csv(path, sep="\t", quote="")
    return tables.read_gff(i.spark, path).withColumnRenamed("_row", "row_no")


@_query
def scan_annot(i: Inputs) -> DataFrame:
    """Gene-function tables, with the order of their lines (which the line of names is one of)."""
    folder = new_path(i.spark, "tables")
    for source, table in i.annotation_tables().items():
        missing = "NA" if source == "GO" else "\\N"
        named = table.orderBy("_row").drop("_row").withColumnRenamed("proteinId", "#proteinId")
        named.write.csv(f"{folder}/set1_{source}.1.tab.gz", sep="\t", header=True, nullValue=missing, compression="gzip")
    found = tables.discover_annotation_tables(i.spark, folder, "set1")
    parts = [
        order.with_rank(t.select("_row", F.lit(s).alias("source"), "proteinId", F.col(G.NAME_COLUMNS[s]).alias("name")), [F.col("_row")], "row_no").drop("_row")
        for s, t in found.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@_query
def scan_csv(i: Inputs) -> DataFrame:
    path = new_path(i.spark, "metadata")
    i.view("metadata").write.csv(path, header=True)
    return tables.read_csv(i.spark, path, "SampleID bigint, GametophyteCode string, Site string")


@_query
def scan_ids(i: Inputs) -> DataFrame:
    path = new_path(i.spark, "ids")
    i.view("metadata").select(F.col("SampleID").cast("string")).write.text(path)
    return tables.read_ids(i.spark, path)


@_query
def typed_reload(i: Inputs) -> DataFrame:
    path = new_path(i.spark, "typed")
    columns = ["CHROM", "POS", "REF", "ALT", "ALT_IDX", "QUAL", "AF", "QD", "DS"]
    tables.write_tsv(_alleles(i).select(columns), path)
    types = ["character", "numeric", "character", "character", "integer", "numeric", "numeric", "numeric", "logical"]
    return tables.read_typed(i.spark, path, dict(zip(columns, types)))


@_query
def sink_roundtrip(i: Inputs) -> DataFrame:
    path = new_path(i.spark, "tsv")
    tables.write_tsv(i.view("kog"), path, compressed=True)
    return tables.read_typed(i.spark, path, "_row bigint, proteinId bigint, kogdefline string").withColumnRenamed("_row", "row_no")


@_query
def sites_only(i: Inputs) -> DataFrame:
    return _sites(i).drop("ROW_ID")


def _must_not_run() -> DataFrame:
    raise AssertionError("a finished stage was built again")


@_query
def stage_reuse(i: Inputs) -> DataFrame:
    path = new_path(i.spark, "stage")
    store.stage(i.spark, path, lambda: _alleles(i).select("ROW_ID", *ALLELE, "ALT_IDX", "AF"))
    return store.stage(i.spark, path, _must_not_run).drop("ROW_ID")


@_query
def stage_by_content(i: Inputs) -> DataFrame:
    """A stage that is built once for the same inputs and plan, and again for another plan."""
    folder = new_path(i.spark, "stages")
    for least in (0.1, 0.2, 0.2):
        rows = _alleles(i).select("ROW_ID", *ALLELE, "ALT_IDX", "AF").filter(F.col("AF") >= least)
        kept = store.stage_by_content(rows, folder, "alleles")
    return kept.drop("ROW_ID")


@_query
def range_layout(i: Inputs) -> DataFrame:
    """Records by scaffold, and how many files of the layout reach over the begin of the next one there."""
    path = new_path(i.spark, "by-region")
    store.write_by_region(_sites(i), path, 8)
    stored = i.spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    files = stored.groupBy("CHROM", "file").agg(F.count("*").alias("n"), F.min("POS").alias("lo"), F.max("POS").alias("hi"), F.sum("POS").alias("sum_pos"))
    reach = F.max("hi").over(Window.partitionBy("CHROM").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("over", F.coalesce(reach > F.col("lo"), F.lit(False))).groupBy("CHROM").agg(
        F.sum("n").alias("n"), F.min("lo").alias("first_pos"), F.max("hi").alias("last_pos"), F.sum("sum_pos").alias("sum_pos"), F.count_if("over").alias("n_over")
    )


# ---- flattening --------------------------------------------------------------------------------


@_query
def parse_info(i: Inputs) -> DataFrame:
    rows = L.parse_info(_sites(i))
    return rows.select("CHROM", "POS", "ALT", "AC", "AF", "AN", "DP", "DS", "END", "MQ", "QD", "RAW_MQandDP")


@_query
def clean_ids(i: Inputs) -> DataFrame:
    rows = L.clean_ids(L.parse_info(_sites(i)), ANN_PREFIX, LIST_PREFIX)
    return rows.select("CHROM", "POS", "ANN", "LOF", "NMD")


@_query
def decompose_alleles(i: Inputs) -> DataFrame:
    return _alleles(i).select(*ALLELE, "ALT_IDX", *INFO)


@_query
def explode_ann(i: Inputs) -> DataFrame:
    return _annotations(i).select(*ALLELE, "ALT_IDX", "ANN_IDX", *ENTRY, "Debug")


@_query
def match_allele(i: Inputs) -> DataFrame:
    rows = L.match_allele(L.explode_ann(_alleles(i), matched=False))
    return rows.select(*ALLELE, "Allele", "Effect", "Gene_ID")


@_query
def project_columns(i: Inputs) -> DataFrame:
    rows = _annotations(i).withColumns({"S_PL": F.lit("1,2"), "S_AD": F.lit("3,4")})
    kept = L.drop_columns(rows, "ID", "FILTER", prefixes=("Debug",), suffixes=("_PL", "_AD"))
    return kept.select([c for c in kept.columns if c in (*ALLELE, *ENTRY, "ID", "FILTER", "Debug", "S_PL", "S_AD")])


def _spoilt(rows: DataFrame) -> DataFrame:
    """Parsed records, of which some are malformed in a list length, in ANN, in LOF and, where there are cells, in one."""
    columns = {
        "AC": F.when(F.col("ROW_ID") % 83 == 2, "1,2,3,4").otherwise(F.col("AC")),
        "ANN": F.when(F.col("ROW_ID") % 97 == 5, F.concat("ANN", F.lit(",x|y"))).otherwise(F.col("ANN")),
        "LOF": F.when(F.col("ROW_ID") % 89 == 7, "a|b|c").otherwise(F.col("LOF")),
    }
    if "CELLS" in rows.columns:
        columns["CELLS"] = F.when(F.col("ROW_ID") % 79 == 11, F.array_append("CELLS", F.lit("1:3,4"))).otherwise(F.col("CELLS"))
    return rows.withColumns(columns)


@_query
def bad_records(i: Inputs) -> DataFrame:
    """Records that were spoilt in a list length, in ANN and in LOF, with the reasons found."""
    return L.bad_records(_spoilt(_parsed(i))).select("ROW_ID", "CHROM", "POS", "Reason")


def _routed(i: Inputs) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    rows = _spoilt(PA.parsed_records(i.vcf(), STUDY))
    return L.route_records(rows, new_path(i.spark, "routed"))


@_query
def route_records(i: Inputs) -> DataFrame:
    """The malformed ones of all records with genotypes, as they were put aside by the scan that stored the rest."""
    return _routed(i)[1].select("ROW_ID", "CHROM", "POS", "Reason")


@_query
def record_counts(i: Inputs) -> DataFrame:
    """What that scan counted on its way."""
    counts = _routed(i)[2]
    kinds = ("records", "AC length", "ANN fields", "LOF fields", "cell fields")
    return i.spark.createDataFrame([(k, counts[k]) for k in kinds], "Fault string, n bigint")


@_query
def info_keys(i: Inputs) -> DataFrame:
    return L.info_keys(_sites(i))


@_query
def info_rest(i: Inputs) -> DataFrame:
    """Undeclared INFO keys of each record, from the VARIANT column."""
    rows = _parsed(i).select("ROW_ID", L.INFO_REST)
    found = rows.lateralJoin(i.spark.tvf.variant_explode(F.col(L.INFO_REST).outer()))
    return found.select("ROW_ID", F.col("key").alias("Key"), F.to_json("value").alias("Value"))


@_query
def info_discovered(i: Inputs) -> DataFrame:
    """Undeclared INFO keys as columns, of the types that their values have."""
    rows = _sites(i)
    return L.parse_info(rows, L.discover_schema(rows)).select("ROW_ID", "LENG", "NOVEL")


@_query
def explode_lof(i: Inputs) -> DataFrame:
    rows = L.explode_lof(_alleles(i))
    return rows.withColumns(
        {"Total_Transcripts_LOF": F.col("Total_Transcripts_LOF").cast("int"), "Percent_Transcripts_LOF": F.col("Percent_Transcripts_LOF").cast("double")}
    )


@_query
def explode_nmd(i: Inputs) -> DataFrame:
    rows = L.explode_nmd(_alleles(i))
    return rows.withColumns(
        {"Total_Transcripts_NMD": F.col("Total_Transcripts_NMD").cast("int"), "Percent_Transcripts_NMD": F.col("Percent_Transcripts_NMD").cast("double")}
    )


def _joined(i: Inputs) -> DataFrame:
    rows = _alleles(i)
    return L.join_lof_nmd(L.explode_ann(rows), L.explode_lof(rows), L.explode_nmd(rows))


@_query
def join_lof_nmd(i: Inputs) -> DataFrame:
    rows = L.blank_fields(_joined(i))
    return rows.select(*ALLELE, "ALT_IDX", "ANN_IDX", "Effect", "Gene_ID", *[c for c in LOSS if "_" in c])


@_query
def flag_lof_nmd(i: Inputs) -> DataFrame:
    rows = L.blank_fields(L.flag_lof_nmd(_joined(i)))
    return rows.select(*ALLELE, "ALT_IDX", "ANN_IDX", "Effect", "Gene_ID", *LOSS, "isLOF", "isNMD")


@_query
def variant_type(i: Inputs) -> DataFrame:
    return L.add_variant_type(_alleles(i)).select(*ALLELE, "Variant_Type")


@_query
def parse_debug(i: Inputs) -> DataFrame:
    return L.parse_debug(_annotations(i)).select(*ALLELE, "Effect", "Protein_ID", "Debug_Code", "Debug_Message")


@_query
def debug_messages(i: Inputs) -> DataFrame:
    return PA.debug_messages(i.vcf(), STUDY)


@_query
def distinct_annotations(i: Inputs) -> DataFrame:
    rows = _annotations(i).select("ROW_ID", *ALLELE, "ALT_IDX", "ANN_IDX", *ENTRY, "Debug")
    return L.distinct_annotations(rows).drop("ROW_ID")


@_query
def split_annotations(i: Inputs) -> DataFrame:
    return PA.split_annotations(i.vcf(), STUDY).select(*ALLELE, "Variant_Type", *INFO, *ENTRY, *LOSS, "isLOF", "isNMD", "INFO_REST")


@_query
def infer_types(i: Inputs) -> DataFrame:
    rows = _annotations(i).select(
        "ROW_ID", "ALT_IDX", *ENTRY, F.col("AF").cast("string"), F.col("QD").cast("string"), F.when(F.col("DS"), "TRUE").otherwise("FALSE").alias("DS")
    )
    return tables.infer_types(rows).drop("ROW_ID", "ALT_IDX")


# ---- summaries ---------------------------------------------------------------------------------


@_query
def effect_counts(i: Inputs) -> DataFrame:
    return Q.effect_counts(_stored_split(i))


@_query
def impact_distribution(i: Inputs) -> DataFrame:
    return Q.impact_distribution(_stored_split(i))


@_query
def type_effect_impact(i: Inputs) -> DataFrame:
    return Q.type_effect_impact(_stored_split(i))


@_query
def label_threshold(i: Inputs) -> DataFrame:
    return Q.label_threshold(Q.type_effect_impact(_stored_split(i)))


@_query
def debug_counts(i: Inputs) -> DataFrame:
    return Q.debug_counts(PA.debug_messages(i.vcf(), STUDY))


@_query
def row_totals(i: Inputs) -> DataFrame:
    return Q.row_totals(_stored_split(i))


def _rounded(boxes: DataFrame) -> DataFrame:
    return boxes.withColumns({c: F.round(c, 6) for c in ("q1", "med", "q3", "lo", "hi")})


@_query
def qc_box_by_effect(i: Inputs) -> DataFrame:
    return _rounded(Q.box_stats(L.explode_effects(_stored_split(i)), "Effect"))


@_query
def qc_box_by_type(i: Inputs) -> DataFrame:
    return _rounded(Q.box_stats(_stored_split(i), "Variant_Type"))


@_query
def qc_sketch_by_effect(i: Inputs) -> DataFrame:
    """Rows per effect and metric, and whether quartiles of merged sketches are where their error bound says.

    Sketches are built and stored for four parts of the table on their own.
    """
    rows = L.explode_effects(_stored_split(i))
    path = new_path(i.spark, "sketches")
    for part in range(4):
        of_part = rows.filter(F.pmod(F.xxhash64("CHROM", "POS"), F.lit(4)) == part)
        Q.box_sketches(of_part, "Effect").write.parquet(f"{path}/part={part}")
    boxes = Q.boxes_of_sketches(i.spark.read.parquet(path), "Effect")
    pairs = [F.struct(F.lit(m).alias("Metric"), F.col(m).cast("double").alias("Value")) for m in Q.BOX_METRICS]
    values = rows.select("Effect", F.inline(F.array(*pairs))).filter("Value is not null")

    def inside(q: str, p: float) -> Column:
        below, upto = F.count_if(F.col("Value") < F.col(q)) / F.count("*"), F.count_if(F.col("Value") <= F.col(q)) / F.count("*")
        return (below - Q.rank_error() <= p) & (upto + Q.rank_error() >= p)

    ranks = [inside(q, p).alias(f"{q}_inside") for q, p in (("q1", 0.25), ("med", 0.5), ("q3", 0.75))]
    return values.join(boxes, ["Effect", "Metric"]).groupBy("Effect", "Metric", "n", "least", "most").agg(*ranks)


@_query
def kept_counts(i: Inputs) -> DataFrame:
    """Effects of a folder of VCF texts that grows between two runs of a stream, from stored partial counts."""
    folder, out = new_path(i.spark, "growing"), new_path(i.spark, "tallies")
    halves = [vcf.to_lines(i.vcf().filter(F.pmod(F.xxhash64("ROW_ID"), F.lit(2)) == half)) for half in (0, 1)]

    def partial(lines: DataFrame) -> DataFrame:
        rows = L.explode_ann(PA.alleles(vcf.parse_lines(lines, genotypes=False), STUDY), distinct=True)
        return L.explode_effects(rows).groupBy("Effect", "Impact").agg(F.count("*").alias("n"))

    for half in halves:
        half.write.mode("append").text(folder)
        tallies.fold(i.spark.readStream.text(folder), out, partial)
    return tallies.summed(tallies.folded(i.spark, out), ["Effect", "Impact"], ["n"])


@_query
def pretty_labels(i: Inputs) -> DataFrame:
    rows = _stored_split(i).groupBy("Effect").agg(F.count("*").alias("n"))
    return rows.withColumn("label", pretty_label(F.col("Effect")))


@_query
def sample_rows(i: Inputs) -> DataFrame:
    return S.sample_rows(_sites(i), "ROW_ID", 0.2, 42)


# ---- record filters and tallies ----------------------------------------------------------------


@_query
def high_impact(i: Inputs) -> DataFrame:
    return _annotations(i).filter(F.col("Impact") == STUDY.impact).select(*ALLELE, *ENTRY)


@_query
def filter_ann_gene(i: Inputs) -> DataFrame:
    return S.filter_ann_gene(_parsed(i), ["gene_7", "gene_70"]).select(*ALLELE)


@_query
def filter_ann_gene_set(i: Inputs) -> DataFrame:
    wanted = _stored_ids(i).select(F.concat(F.lit("gene_"), F.col("Protein_ID").cast("bigint") - 9000000).alias("Gene_ID"))
    return S.filter_ann_gene(_parsed(i), wanted).select(*ALLELE)


@_query
def filter_lof_nmd(i: Inputs) -> DataFrame:
    return S.filter_lof_nmd(_parsed(i)).select(*ALLELE, "LOF", "NMD")


@_query
def multiallelic_snps(i: Inputs) -> DataFrame:
    return S.multiallelic(_sites(i), "snp").select(*ALLELE)


@_query
def multiallelic_indels(i: Inputs) -> DataFrame:
    return S.multiallelic(_sites(i), "indel").select(*ALLELE)


@_query
def variant_counts(i: Inputs) -> DataFrame:
    return S.variant_counts(i.vcf(), i.header_samples())


@_query
def variant_stats(i: Inputs) -> DataFrame:
    return S.variant_stats(i.vcf(), i.header_samples())


@_query
def ts_tv(i: Inputs) -> DataFrame:
    return S.ts_tv(_alleles(i))


@_query
def substitution_counts(i: Inputs) -> DataFrame:
    return S.substitution_counts(_alleles(i))


@_query
def indel_lengths(i: Inputs) -> DataFrame:
    return S.indel_lengths(_alleles(i))


@_query
def quality_histogram(i: Inputs) -> DataFrame:
    return S.quality_histogram(_sites(i))


@_query
def depth_histogram(i: Inputs) -> DataFrame:
    records = i.vcf()
    return S.depth_histogram(L.parse_info(records), C.cells_long(records, None))


@_query
def site_list(i: Inputs) -> DataFrame:
    ids, table = _gene_table(i)
    return PA.high_impact_sites(i.vcf(), ids, table, STUDY)


@_query
def subset_sites(i: Inputs) -> DataFrame:
    return S.subset_sites(i.vcf(), _stored_sites(i), "pos").select(*ALLELE, F.size("CELLS").alias("n_samples"))


@_query
def subset_sites_overlap(i: Inputs) -> DataFrame:
    return S.subset_sites(_sites(i), _stored_sites(i).withColumn("POS", F.col("POS") + 1), "overlap").select(*ALLELE)


@_query
def spans_on_genes(i: Inputs) -> DataFrame:
    """Records longer than a base and the genes they reach, by position alone."""
    spans = _sites(i).select("ROW_ID", "CHROM", "POS", S.span_end(_sites(i)).alias("last")).filter(F.col("last") > F.col("POS"))
    genes = G.gff_features(i.gff()).filter(F.col("Type") == "gene").select("CHROM", "ID", "feature_start", "feature_end")
    return intervals.overlaps(spans, genes, "CHROM", ("POS", "last"), ("feature_start", "feature_end")).drop("last")


# ---- genes -------------------------------------------------------------------------------------


@_query
def gff_features(i: Inputs) -> DataFrame:
    return G.gff_features(i.gff()).withColumnRenamed("_row", "row_no")


@_query
def gff_fill(i: Inputs) -> DataFrame:
    rows = G.fill_gene_ids(G.gff_features(i.gff()), chunk_rows=1000)
    return rows.select(F.col("_row").alias("row_no"), "Gene_ID", "Protein_ID", "Transcript_ID", "Protein_Product")


@_query
def collapse_annotations(i: Inputs) -> DataFrame:
    parts = None
    for source, table in i.annotation_tables().items():
        part = G.collapse_annotations(table, source).select(
            F.lit(source).alias("source"), "Protein_ID", F.col(source).alias("names")
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


@_query
def search_terms(i: Inputs) -> DataFrame:
    parts = None
    for source, table in i.annotation_tables().items():
        part = G.search_terms(table, source).withColumn("source", F.lit(source))
        parts = part if parts is None else parts.unionByName(part)
    return parts


@_query
def term_table(i: Inputs) -> DataFrame:
    """Proteins and the terms in their names, from a table of terms: the search terms, brands, types and segments."""
    parts = i.table("part").select(F.explode(F.array("p_brand", "p_type")).alias("term"))
    wanted = parts.union(i.table("customer").select("c_mktsegment")).union(i.spark.createDataFrame([(t,) for t in STUDY.search_terms], "term string")).distinct()
    names = None
    for source, table in i.annotation_tables().items():
        part = table.select(F.lit(source).alias("source"), F.col("proteinId").cast("string").alias("Protein_ID"), F.col(G.NAME_COLUMNS[source]).alias("name"))
        names = part if names is None else names.unionByName(part)
    return terms.matches(names.dropDuplicates(), wanted, ["source", "Protein_ID"], "name")


@_query
def proteins_of_interest(i: Inputs) -> DataFrame:
    return _gene_table(i)[0]


@_query
def full_join_annotations(i: Inputs) -> DataFrame:
    t = i.annotation_tables()
    return G.full_join_annotations(t["GO"], t["IPR"], t["KEGG"], t["KOG"])


@_query
def gene_annotations(i: Inputs) -> DataFrame:
    return _gene_table(i)[1]


@_query
def annotate_override(i: Inputs) -> DataFrame:
    rows = G.fill_gene_ids(G.gff_features(i.gff()))
    patched = G.annotate_override(rows, {"9000007": "patched product (Exo1)", "9000009": "helicase"})
    return patched.select(F.col("_row").alias("row_no"), "Protein_ID", "Protein_Product")


@_query
def variants_in_genes(i: Inputs) -> DataFrame:
    rows = G.variants_in_genes(_annotations(i), _stored_genes(i))
    return rows.select("CHROM", "POS", "REF", "ALT", "Effect", "Gene_ID", "Type", "feature_start", "feature_end", "GO")


# ---- calls -------------------------------------------------------------------------------------

CALL = ["SampleID", "GT", "DP_S", "GQ", "AD_REF", "AD_ALT", "PL_REF", "PL_ALT"]


@_query
def parse_calls(i: Inputs) -> DataFrame:
    rows = C.parse_calls(i.vcf().select("ROW_ID", "FORMAT", "CELLS"), by_format=True)
    rows = rows.select("ROW_ID", F.posexplode("CALLS").alias("place", "call"))
    return rows.select("ROW_ID", "place", "call.*")


@_query
def ref_alt_depth(i: Inputs) -> DataFrame:
    rows = C.ref_alt_depth(C.parse_calls(i.vcf().select("ROW_ID", "CELLS")))
    rows = rows.select("ROW_ID", F.posexplode("CALLS").alias("place", "call"))
    return rows.select("ROW_ID", "place", "call.AD_REF", "call.AD_ALT", "call.PL_REF", "call.PL_ALT")


@_query
def calls_long(i: Inputs) -> DataFrame:
    return C.cells_long(i.vcf().select("ROW_ID", "CHROM", "POS", "CELLS"), i.header_samples()).select("ROW_ID", "CHROM", "POS", *CALL)


@_query
def allele_call_counts(i: Inputs) -> DataFrame:
    records = C.genotypes(PA.parsed_records(i.vcf(), STUDY))
    return C.allele_call_counts(L.decompose_alleles(records)).select("ROW_ID", *ALLELE, "ALT_IDX", "N_ALT_GTS", "N_CALLS")


@_query
def drop_singletons(i: Inputs) -> DataFrame:
    return C.drop_singletons(allele_call_counts(i), STUDY.min_alt_genotypes)


@_query
def site_allele_summary(i: Inputs) -> DataFrame:
    return C.site_allele_summary(PX.call_rows(i.vcf(), STUDY))


@_query
def split_calls(i: Inputs) -> DataFrame:
    rows = C.calls_long(PX.split_calls(i.vcf(), _stored_sites(i), STUDY), i.header_samples())
    return rows.select(
        "ROW_ID", *ALLELE, "ALT_IDX", "Effect", "N_ALT_GTS", "N_CALLS", "N_ALT_ALLELES", "N_ALT_DISTINCT", "ALT_SUMMARY",
        "Total_Transcripts_LOF", "Percent_Transcripts_LOF", "isLOF", "isNMD", *CALL,
    )


@_query
def annotate_variants(i: Inputs) -> DataFrame:
    rows = G.annotate_variants(_annotations(i), _stored_genes(i))
    return rows.select(*ALLELE, "Effect", "Gene_ID", "Protein_ID", "GO", "IPR", "KEGG", "KOG", "Protein_Product", "feature_start")


@_query
def effect_severity(i: Inputs) -> DataFrame:
    return R.effect_severity(_annotations(i)).select(*ALLELE, "Effect", "Effect_Rank")


@_query
def merge_annotations(i: Inputs) -> DataFrame:
    rows = R.merge_annotations(_stored_genes(i))
    return rows.select("Protein_ID", "ID", "Annotations")


@_query
def term_rank(i: Inputs) -> DataFrame:
    rows = R.term_rank(R.merge_annotations(_stored_genes(i)))
    return rows.select("Protein_ID", "ID", "Matched_Terms", "Annot_Rank")


@_query
def rank_variants(i: Inputs) -> DataFrame:
    """Ranked variant rows, with the place among alleles that their order gives them."""
    ordered = order.with_rank(_ranked(i), R.rank_keys(), "Place")
    return ordered.select(
        "Place", "ROW_ID", *ALLELE, "ALT_IDX", "Effect", "Gene_ID", "Comb_Rank", "Effect_Rank", "Matched_Terms", "Annot_Rank",
        "AF", "N_ALT_GTS", "N_CALLS", "N_ALT_ALLELES", "Annotations", "Total_Transcripts_LOF", "Total_Transcripts_NMD",
    )


# ---- crosses -----------------------------------------------------------------------------------

KEPT = ["ROW_ID", *ALLELE, "ALT_IDX", "Effect", "Gene_ID", "Comb_Rank", "AF", "N_ALT_GTS", "GametophyteCode", "Sex", *CALL]


@_query
def sample_index(i: Inputs) -> DataFrame:
    return X.sample_index(i.view("metadata"))


@_query
def sample_id_check(i: Inputs) -> DataFrame:
    """Samples that only the metadata or only the header of the VCF has."""
    return X.sample_id_check(i.view("metadata"), vcf.vcf_samples(i.spark, _vcf_text(i)))


@_query
def calls_with_sample(i: Inputs) -> DataFrame:
    return PX.sample_calls(_stored_ranked(i), i.header_samples(), _samples(i)).select(*KEPT)


def _good(i: Inputs) -> DataFrame:
    return PX.good_calls(_stored_ranked(i), i.header_samples(), _samples(i), STUDY)


@_query
def filter_calls(i: Inputs) -> DataFrame:
    return _good(i).select(*KEPT)


@_query
def both_sexes(i: Inputs) -> DataFrame:
    return X.both_sexes(_good(i)).select(*KEPT)


@_query
def top_samples(i: Inputs) -> DataFrame:
    return PX.kept_samples(_stored_ranked(i), i.header_samples(), _samples(i), STUDY).select(*KEPT)


@_query
def expand_crosses(i: Inputs) -> DataFrame:
    rows = PX.cross_table(_stored_ranked(i), i.header_samples(), _samples(i), STUDY)
    return rows.select("F_ID", "M_ID", "Cross", "ROW_ID", *ALLELE)


def _crosses(i: Inputs) -> DataFrame:
    return PX.cross_table(_ranked(i), i.header_samples(), _samples(i), STUDY)


@_query
def cross_table(i: Inputs) -> DataFrame:
    return _crosses(i).select(
        "F_ID", "M_ID", "Cross", "Comb_Rank", "Effect_Rank", "Matched_Terms", "Annot_Rank", *ALLELE, "AF", "Effect", "Gene_ID",
        "Protein_ID", "N_ALT_GTS", "N_ALT_ALLELES", "Annotations",
    )


@_query
def cross_list(i: Inputs) -> DataFrame:
    return X.cross_list(_crosses(i))


@_query
def best_crosses(i: Inputs) -> DataFrame:
    """The first 100 crosses, from the best variant rows only."""
    return PX.best_crosses(_stored_ranked(i), i.header_samples(), _samples(i), STUDY)
