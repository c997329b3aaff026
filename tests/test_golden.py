"""Single cases with a result known from the rules."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from varloom.functions import alleles, scoring, text
from varloom.operators import calls, crosses, flatten, genes, ranking, sites
from varloom.params import ANN_FIELDS, EFFECT_SEVERITY, TERM_RANK


def one(spark, expression, **values):
    names = list(values) or ["x"]
    row = tuple(values.values()) or (None,)
    schema = ", ".join(f"{n} {'int' if isinstance(v, int) else 'string'}" for n, v in zip(names, row))
    return spark.createDataFrame([row], schema).select(expression.alias("out")).first()["out"]


def ann(allele="G", effect="stop_gained", protein="77", gene="gene_5", hgvs="c.1", debug=""):
    fields = [allele, effect, "HIGH", protein, gene, "transcript", "f", "b", "1/1", hgvs, "p", "1/2", "1/2", "1/2", "", debug]
    return "|".join(fields)


def record(spark, ref="A", alt="G", info="AC=1", row=1, pos=10, cells=None):
    data = {"ROW_ID": row, "CHROM": "c", "POS": pos, "ID": ".", "REF": ref, "ALT": alt, "QUAL": 1.0, "FILTER": ".", "INFO": info}
    if cells:
        data |= {"FORMAT": "GT:AD:DP:GQ:PL", "CELLS": cells}
    return spark.createDataFrame([Row(**data)])


def test_info_flag_extra_equals_and_repeated_key(spark):
    schema = {"AC": ("int", "1"), "DS": ("boolean", "0"), "X": ("string", "1"), "AN": ("int", "1")}
    row = flatten.parse_info(record(spark, info="AC=1;DS;X=a=b;AC=2"), schema).first()
    assert (row.AC, row.DS, row.X, row.AN) == (2, True, "a=b", None)


def test_clean_ids_before_split(spark):
    raw = record(spark, info=f"ANN={ann(protein='db.p|Gnm|77')};LOF=(db.p_Gnm_77|gene_5|1|0.5)")
    cleaned = flatten.clean_ids(flatten.parse_info(raw), "db.p|Gnm|", "db.p_Gnm_")
    assert cleaned.first().LOF == "77|gene_5|1|0.5"
    rows = flatten.explode_ann(flatten.decompose_alleles(cleaned)).collect()
    assert [(r.Protein_ID, r.Gene_ID) for r in rows] == [("77", "gene_5")]


def test_decompose(spark):
    rows = flatten.decompose_alleles(flatten.parse_info(record(spark, alt="G,T", info="AF=0.1,0.2;DP=30;RAW_MQandDP=1,2;AC=7"))).collect()
    assert [(r.ALT, r.ALT_IDX, r.AF, r.DP, r.RAW_MQandDP, r.AC) for r in rows] == [
        ("G", 1, 0.1, 30, "1,2", 7),
        ("T", 2, 0.2, 30, "1,2", 7),
    ]


def test_match_allele_and_list_index(spark):
    raw = record(spark, alt="G,T", info=f"ANN={ann('T')},{ann('G')},{ann('GG')}")
    rows = flatten.explode_ann(flatten.decompose_alleles(flatten.parse_info(raw))).collect()
    assert sorted((r.ALT, r.ANN_IDX) for r in rows) == [("G", 2), ("T", 1)]


def test_distinct_entries_ignore_messages_only(spark):
    raw = record(spark, info=f"ANN={ann(debug='E_1')},{ann()},{ann(effect='x')}")
    rows = flatten.explode_ann(flatten.decompose_alleles(flatten.parse_info(raw)), distinct=True).collect()
    assert [(r.Effect, r.ANN_IDX) for r in rows] == [("stop_gained", 1), ("x", 2)]
    assert "Debug" not in rows[0]


@pytest.mark.parametrize("distinct", [False, True])
def test_wrong_field_count(spark, distinct):
    for bad in ("G|stop_gained|HIGH", ann() + "|x", ann().rsplit("|", 1)[0]):
        raw = flatten.parse_info(record(spark, info=f"ANN={ann()},{bad}"))
        rows = flatten.decompose_alleles(raw)
        assert flatten.explode_ann(rows, distinct=distinct).count() == 1
        with pytest.raises(PySparkException, match="expected"):
            flatten.explode_ann(rows, distinct=distinct, mode="failfast").collect()
        assert flatten.bad_records(raw).first().Reason == "ANN fields"


def test_bad_lists_and_cells(spark):
    raw = record(spark, alt="G,T", info="AC=1,2,3;LOF=(a|b)", cells=["0:1,2:3:4:5", "0:1"])
    assert flatten.bad_records(flatten.clean_ids(flatten.parse_info(raw))).first().Reason == "AC length, LOF fields, cell fields"
    fine = record(spark, alt="G,T", info="AC=1,2", cells=["0:1,2:3:4:5"])
    assert flatten.bad_records(flatten.parse_info(fine)).count() == 0


def test_messages(spark):
    rows = spark.createDataFrame([("WARNING_NO_START&INFO_X_Y&PLAIN",), ("",)], "Debug string")
    out = {(r.Debug_Code, r.Debug_Message) for r in flatten.parse_debug(rows).collect()}
    assert out == {("WARNING", "NO_START"), ("INFO", "X_Y"), ("PLAIN", ""), (None, None)}


@pytest.mark.parametrize("ref,alt,kind", [("A", "G", "SNP"), ("A", "AT", "INDEL"), ("AT", "GC", "SNP"), ("A", "*", "INDEL")])
def test_variant_type(spark, ref, alt, kind):
    assert one(spark, alleles.variant_type(F.col("r"), F.col("a")), r=ref, a=alt) == kind


@pytest.mark.parametrize(
    "ref,alt,kind",
    [
        ("A", "G", "snp"),
        ("a", "G", "snp"),
        ("AC", "AG", "snp"),
        ("ACT", "GCA", "mnp"),
        ("A", "ATT", "indel"),
        ("ATT", "A", "indel"),
        ("AG", "G", "indel"),
        ("AAT", "C", "other"),
        ("A", "*", "overlap"),
        ("A", "<DEL>", "other"),
        ("A", ".", "ref"),
    ],
)
def test_allele_class(spark, ref, alt, kind):
    assert one(spark, alleles.allele_class(F.col("r"), F.col("a")), r=ref, a=alt) == kind


@pytest.mark.parametrize(
    "total,effect,flag", [("1", "stop_gained&splice_region_variant", True), ("1", "intron_variant", False), (None, "stop_gained", False)]
)
def test_lof_flag(spark, total, effect, flag):
    schema = "Total_Transcripts_LOF string, Total_Transcripts_NMD string, HGVS_c string, Effect string, LOF string"
    row = flatten.flag_lof_nmd(spark.createDataFrame([(total, None, "", effect, "x")], schema)).first()
    assert (row.isLOF, row.isNMD, row.LOF) == (flag, False, "x" if flag else None)


def test_gated_join_equals_join_flag_distinct(spark):
    lines = []
    for row, (effect, lof) in enumerate(
        [
            ("stop_gained", "(77|gene_5|1|1.0),(77|gene_5|2|0.5),(77|gene_5|2|0.50)"),
            ("intron_variant", "(77|gene_5|1|1.0),(77|gene_5|2|0.5)"),
            ("stop_gained", None),
        ]
    ):
        lines.append(record(spark, row=row, info=f"ANN={ann(effect=effect)}" + (f";LOF={lof};NMD=(77|gene_5|1|1.0)" if lof else "")))
    raw = lines[0].union(lines[1]).union(lines[2])
    rows = flatten.decompose_alleles(flatten.clean_ids(flatten.parse_info(raw)))
    entries, lof, nmd = flatten.explode_ann(rows), flatten.explode_lof(rows), flatten.explode_nmd(rows)
    plain = flatten.blank_fields(flatten.flag_lof_nmd(flatten.join_lof_nmd(entries, lof, nmd))).distinct()
    gated = flatten.blank_fields(flatten.join_counted_lof_nmd(entries, lof, nmd))
    assert sorted(map(str, gated.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


CELLS = ["2:9,1,7:30:40:1,2,3", "0:9,1:5:.:4,5", ".:9,1:.:3:.", "0/1:9,1:1:1:1", "1:.:7:8:1.5"]


def test_calls(spark):
    raw = record(spark, alt="G,T", cells=CELLS)
    typed = calls.ref_alt_depth(calls.parse_calls(raw)).first().CALLS
    got = [(c.GT, c.AD, c.DP_S, c.GQ, c.PL, c.AD_REF, c.AD_ALT, c.PL_REF, c.PL_ALT) for c in typed]
    want = [
        (2, "9,1,7", 30, 40, "1,2,3", 9, 7, 1, 3),
        (0, "9,1", 5, None, "4,5", 9, None, 4, None),
        (None, "9,1", None, 3, None, None, None, None, None),
        (None, "9,1", 1, 1, "1", None, None, None, None),
        (1, ".", 7, 8, None, None, None, None, None),
    ]
    assert got == want
    header = spark.createDataFrame(list(enumerate(range(101, 106))), "SAMPLE_POS int, SampleID bigint")
    long = calls.cells_long(raw, header).orderBy("SAMPLE_POS").collect()
    assert [(c.GT, c.AD, c.DP_S, c.GQ, c.PL, c.AD_REF, c.AD_ALT, c.PL_REF, c.PL_ALT) for c in long] == want


def test_calls_by_format(spark):
    raw = record(spark, cells=["7:1:5,6"]).withColumn("FORMAT", F.lit("GQ:GT:AD"))
    call = calls.parse_calls(raw, by_format=True).first().CALLS[0]
    assert (call.GT, call.AD, call.DP_S, call.GQ, call.PL) == (1, "5,6", None, 7, None)


def test_counts_and_site_summary(spark):
    raw = record(spark, alt="G,T", cells=["1", "1", "2", ".", "0"])
    rows = calls.allele_call_counts(flatten.decompose_alleles(calls.genotypes(raw)))
    assert [(r.N_ALT_GTS, r.N_CALLS) for r in rows.orderBy("ALT_IDX").collect()] == [(2, 4), (1, 4)]
    summary = calls.site_allele_summary(rows).first()
    assert (summary.N_ALT_ALLELES, summary.N_ALT_DISTINCT, summary.ALT_SUMMARY) == (2, 2, "2:A>G, 1:A>T")


def test_effect_rank(spark):
    rank = scoring.effect_rank(F.col("e"), EFFECT_SEVERITY)
    assert one(spark, rank, e="stop_gained&splice_region_variant") == 1
    assert one(spark, rank, e="synonymous_variant") == float("inf")


def test_merged_annotations(spark):
    columns = "IPR string, KEGG string, GO string, KOG string, Protein_Product string"
    rows = spark.createDataFrame([("a;b", None, "b;c", None, None), (None,) * 5], columns)
    assert [r.Annotations for r in ranking.merge_annotations(rows).collect()] == ["a;b;c", ""]


def test_terms(spark):
    rows = spark.createDataFrame([("SPO11-like; telomere",), ("kinase",), ("",)], "Annotations string")
    got = [(r.Matched_Terms, r.Annot_Rank) for r in ranking.term_rank(rows).collect()]
    assert got == [("Spo11, telomere", 1), (None, 5), (None, 5)]
    assert max(TERM_RANK.values()) == 4


def test_label_and_sex(spark):
    assert one(spark, text.pretty_label(F.col("x")), x="5_prime_UTR_variant&stop_gained") == "5 ' UTR & stop gained"
    assert one(spark, text.sex_from_code(F.col("x")), x="ST.F.12") == "F"
    assert one(spark, text.sex_from_code(F.col("x")), x="ST.X.12") is None


def gff(spark, *attributes):
    rows = [(i, "c", "s", "CDS", 1, 2, ".", "+", ".", a) for i, a in enumerate(attributes)]
    return spark.createDataFrame(
        rows, "_row bigint, CHROM string, Source string, Type string, Start bigint, End bigint, Score string, Strand string, Phase string, Attributes string"
    )


def test_gene_ids(spark):
    rows = genes.gff_features(gff(spark, "ID=a_1;Parent=gene_12", "ID=gene_7", "ID=z;Parent=x", "Note=n")).orderBy("_row").collect()
    assert [r.Gene_ID for r in rows] == ["gene_12", "gene_7", "gene_NA", "gene_NA"]


@pytest.mark.parametrize("chunk", [1, 2, 1000])
def test_fill(spark, chunk):
    rows = gff(spark, "ID=gene_1", "ID=a_1;proteinId=5", "ID=b_1", "ID=c_1;proteinId=6", "ID=gene_2")
    rows = genes.gff_features(rows).withColumn("Gene_ID", F.when(F.col("ID") == "gene_2", "gene_2").otherwise("gene_1"))
    filled = genes.fill_gene_ids(rows, chunk).orderBy("_row").collect()
    assert [r.Protein_ID for r in filled] == ["5", "5", "5", "6", None]


def test_collapse(spark):
    go = spark.createDataFrame([(0, 1, "a"), (1, 1, None), (2, 1, "a")], "_row bigint, proteinId bigint, goName string")
    kog = spark.createDataFrame([(0, 1, None)], "_row bigint, proteinId bigint, kogdefline string")
    assert genes.collapse_annotations(go, "GO").first().GO == "a;NA;a"
    assert genes.collapse_annotations(kog, "KOG").first().KOG == ""


def test_override(spark):
    rows = spark.createDataFrame([("9000321", None), ("9000321", "p"), ("1", None)], "Protein_ID string, Protein_Product string")
    got = [r.Protein_Product for r in genes.annotate_override(rows, {"9000321": "patched product (Exo1)"}).collect()]
    assert got == ["NA;patched product (Exo1)", "p;patched product (Exo1)", None]


def call_table(spark, rows):
    """Kept calls; each row gives the columns that matter for its case."""
    default = {
        "ROW_ID": 1, "ALT_IDX": 1, "ANN_IDX": 1, "CHROM": "c", "POS": 1, "REF": "A", "ALT": "G", "Comb_Rank": 2.0, "N_ALT_GTS": 2, "AF": 0.1,
        "N_ALT_ALLELES": 1, "Total_Transcripts_LOF": None, "Percent_Transcripts_LOF": None, "Total_Transcripts_NMD": None,
        "Percent_Transcripts_NMD": None, "ID": "gene_1", "SAMPLE_POS": 0, "SampleID": 1, "GametophyteCode": "x", "Sex": "F", "GT": 1, "DP_S": 10,
        "GQ": 20, "AD_REF": 1, "AD_ALT": 5, "PL_REF": 0, "PL_ALT": 0,
    }
    kinds = {str: "string", int: "int", float: "double"}
    types = {"Percent_Transcripts_LOF": "double", "Percent_Transcripts_NMD": "double"}
    schema = ", ".join(f"{k} {types.get(k, kinds.get(type(v), 'int'))}" for k, v in default.items())
    full = [tuple((default | {"SAMPLE_POS": i, "SampleID": i} | row).values()) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, schema)


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize(
    "sexes,strict,kept",
    [
        (["F", "M"], True, True),
        (["F"], True, False),
        (["F", None], True, True),
        (["F", "M", None], True, False),
        (["F", None], False, False),
        (["F", "M", None], False, True),
    ],
)
def test_sexes(spark, sexes, strict, kept, few):
    rows = call_table(spark, [{"Sex": s} for s in sexes])
    assert crosses.both_sexes(rows, strict, few).count() == (len(sexes) if kept else 0)


def test_top_calls(spark):
    rows = call_table(spark, [{"Comb_Rank": r} for r in (2.0, 1.0, 1.0, None)])
    assert sorted(r.SAMPLE_POS for r in crosses.top_samples(rows, 2).collect()) == [1, 2]
    twice = call_table(spark, [{"SampleID": 7, "ANN_IDX": 1}, {"SampleID": 7, "ANN_IDX": 2}, {"SampleID": 8, "ANN_IDX": 3}])
    assert sorted(r.SampleID for r in crosses.top_samples(twice, 2).collect()) == [7, 7]
    assert sorted(r.SampleID for r in crosses.top_samples(twice, 2, per_sample=True).collect()) == [7, 8]


def test_crosses_and_rank(spark):
    rows = call_table(
        spark,
        [
            {"GametophyteCode": "f1", "GQ": 90},
            {"GametophyteCode": "f2", "GQ": 80},
            {"GametophyteCode": "m1", "GQ": 70, "Sex": "M"},
            {"GametophyteCode": "m2", "GQ": 60, "Sex": "M"},
            {"GametophyteCode": "f9", "GQ": 99, "ROW_ID": 2, "Comb_Rank": 9.0},
            {"GametophyteCode": "m1", "GQ": 99, "ROW_ID": 2, "Comb_Rank": 9.0, "Sex": "M"},
            {"GametophyteCode": "f1", "GQ": 99, "ROW_ID": 3, "Comb_Rank": None},
            {"GametophyteCode": "m2", "GQ": 99, "ROW_ID": 3, "Comb_Rank": None, "Sex": "M"},
            {"GametophyteCode": "f5", "GQ": 99, "ROW_ID": 4, "Comb_Rank": 0.0},
        ],
    )
    table = crosses.expand_crosses(rows)
    assert table.count() == 6
    listed = [(r.Rank, r.Cross) for r in crosses.cross_list(table).orderBy("Rank").collect()]
    assert listed == [(1, "f1 x m1"), (2, "f2 x m1"), (3, "f1 x m2"), (4, "f2 x m2"), (5, "f9 x m1")]


def test_one_index_row_per_sample(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "SampleID bigint")
    index = spark.createDataFrame([(1, "a", "F"), (2, "b", None)], "SampleID bigint, GametophyteCode string, Sex string")
    got = {(r.SampleID, r.GametophyteCode, r.Sex) for r in crosses.calls_with_sample(rows, index).collect()}
    assert got == {(1, "a", "F"), (2, "b", None), (3, None, None)}
    with pytest.raises(PySparkException, match="more than one index row for sample 1"):
        crosses.calls_with_sample(rows, index.union(index.filter("SampleID = 1"))).collect()


def test_sample_ids_of_one_side(spark):
    ids = [spark.createDataFrame([(i,) for i in side], "SampleID bigint") for side in ([1, 2, 3], [2, 3, 4])]
    assert {tuple(r) for r in crosses.sample_id_check(*ids).collect()} == {(1, "metadata"), (4, "vcf")}
    assert crosses.sample_id_check(ids[0], ids[0]).count() == 0


def test_subset_modes(spark):
    records = record(spark, pos=10).union(record(spark, ref="ACGT", pos=8, row=2)).union(record(spark, ref="A" * 2500, pos=1, row=3))
    listed = spark.createDataFrame([("c", 10), ("c", 2000)], "CHROM string, POS int")
    assert [r.POS for r in sites.subset_sites(records, listed, "pos").collect()] == [10]
    assert sorted(r.POS for r in sites.subset_sites(records, listed).collect()) == [1, 8, 10]


def test_gene_filter_reads_the_gene_field(spark):
    raw = flatten.parse_info(record(spark, info=f"ANN={ann(protein='gene_9')},{ann(gene='gene_50')}"))
    wanted = spark.createDataFrame([("gene_5",), ("gene_50",)], "Gene_ID string")
    for gene, n in (("gene_9", 0), ("gene_5", 1), ("gene_50", 1), ("gene_0", 0)):
        assert sites.filter_ann_gene(raw, [gene]).count() == n
    assert sites.filter_ann_gene(raw, wanted).count() == 1


def test_guessed_types_keep_codes(spark):
    from varloom.sources.tables import infer_types

    values = {"a": ["007", "1"], "b": ["12d", "1"], "c": ["1e5", "NA"], "d": ["-0.5", ".5"], "e": ["3f", ""], "f": ["0", "10"]}
    rows = spark.createDataFrame(list(zip(*values.values(), strict=True)), list(values))
    kinds = dict(infer_types(rows).dtypes)
    assert kinds == {"a": "string", "b": "string", "c": "double", "d": "double", "e": "string", "f": "double"}


def test_misspelt_mode_is_refused(spark):
    from varloom.params import Params

    with pytest.raises(ValueError, match="mode is one of"):
        Params(mode="permisive")
    with pytest.raises(ValueError, match="mode is one of"):
        flatten.explode_ann(flatten.decompose_alleles(flatten.parse_info(record(spark, info="ANN=" + ann()))), mode="strict")


def test_calls_follow_the_format_of_their_record(spark):
    from varloom.plans import crosses as plans

    rows = spark.createDataFrame(
        [(1, "GT:AD:DP:GQ:PL", ["1:3,4:7:50:9,0"]), (2, "GT:PL:GQ:PGT:AD:DP", ["1:9,0:50:x:3,4:7"])],
        "ROW_ID long, FORMAT string, CELLS array<string>",
    )
    got = [r.CALLS[0].asDict() for r in plans.with_calls(rows).collect()]
    assert got[0] == got[1] and got[0]["DP_S"] == 7 and got[0]["PL_ALT"] == 0
