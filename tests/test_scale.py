"""Plans, hot groups, stored stages, and sources."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom import catalog
from varloom.fixtures import STUDY
from varloom.operators import calls, crosses, flatten, genes, intervals, order, qc, sites
from varloom.params import Params
from varloom.plans import annotations as PA
from varloom.plans import crosses as PX
from varloom.session import shared_dir
from varloom.sources import store, tables, vcf
from varloom.streaming.scan import stream_vcf


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured is None or shared_dir(spark) == configured
    assert spark.sparkContext.getCheckpointDir()


def test_no_python_in_any_plan(spark, sf_dir):
    for name in ("split_annotations", "gene_annotations", "rank_variants", "cross_table", "qc_box_by_effect", "subset_sites"):
        text = plan(catalog.queries()[name](spark, sf_dir))
        assert "Python" not in text and "Pandas" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_semi_joins_and_group_limit(spark, sf_dir):
    assert "LeftSemi" in plan(catalog.queries()["subset_sites"](spark, sf_dir))
    assert "WindowGroupLimit" in plan(catalog.queries()["top_samples"](spark, sf_dir))


def test_scan_reads_the_columns_it_needs(inputs):
    text = plan(sites.ts_tv(flatten.decompose_alleles(flatten.parse_info(sites.sites_only(inputs.vcf())))))
    schema = text[text.index("ReadSchema") :].split("\n")[0]
    assert "CELLS" not in schema and "FILTER" not in schema and "INFO" not in schema


def test_region_filter_reaches_the_scan(spark, inputs):
    path = f"{shared_dir(spark)}/region-{random.random()}"
    store.write_by_region(inputs.vcf(), path, partitions=4)
    rows = store.read_region(spark, path, "scaffold_3", 10000, 90000)
    assert "PushedFilters: [IsNotNull(CHROM), IsNotNull(POS), EqualTo(CHROM,scaffold_3)" in plan(rows)
    want = inputs.vcf().filter("CHROM = 'scaffold_3' and POS between 10000 and 90000")
    assert 0 < rows.count() == want.count()


def test_skewed_join_is_split_with_the_same_rows(spark, inputs):
    def hot(df):
        third = F.xxhash64("POS") % 3 == 0
        keys = {"CHROM": "h", "POS": 1, "ALT": "G", "Gene_ID": "gene_h", "Protein_ID": "h"}
        return df.withColumn("_h", third).withColumns({k: F.when(F.col("_h"), v).otherwise(F.col(k)) for k, v in keys.items()}).drop("_h")

    rows = PA.alleles(sites.sites_only(inputs.vcf()), STUDY)
    lof, nmd = (hot(side) for side in PA.lof_and_nmd(inputs.vcf(), STUDY))
    entries = hot(flatten.explode_ann(rows))
    want = sorted(map(str, flatten.join_counted_lof_nmd(entries, lof, nmd).collect()))
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        split = flatten.join_counted_lof_nmd(entries, lof, nmd)
        got = sorted(map(str, split.collect()))
        assert "skew=true" in plan(split)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == want


def test_fill_of_a_hot_group(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.4 else f"g{rng.randrange(40)}", f"p{i}" if rng.random() < 0.1 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "n bigint, g string, v string").repartition(5)
    filled = {r.n: r.v for r in order.fill_down_up(df, "g", "n", ["v"], F.floor(F.col("n") / 37)).collect()}
    last, first = {}, {}
    for n, g, v in rows:
        if v is not None:
            first.setdefault(g, v)
    for n, g, v in rows:
        last[g] = v if v is not None else last.get(g)
        assert filled[n] == (last[g] if last[g] is not None else first.get(g))


def test_rank_is_dense_and_ordered(spark):
    rng = random.Random(4)
    rows = [(rng.random(), i) for i in range(5000)]
    ranked = order.with_rank(spark.createDataFrame(rows, "x double, i int").repartition(7), [F.col("x"), F.col("i")])
    got = {r.i: r.Rank for r in ranked.collect()}
    assert [i for _, i in sorted(rows)] == sorted(got, key=got.get)
    assert sorted(got.values()) == list(range(1, 5001))


@pytest.mark.parametrize("buckets", [2, 50])
def test_box_against_numpy(spark, buckets):
    rng = np.random.default_rng(5)
    groups = {"hot": rng.normal(size=3000), "few": np.array([1.0, 2.0, 50.0, 2.0]), "one": np.array([7.0]), "same": np.full(100, 3.0)}
    rows = [(g, float(round(v, 2))) for g, values in groups.items() for v in values] + [("few", None)]
    boxes = qc.box_stats(spark.createDataFrame(rows, "g string, v double"), "g", ["v"], buckets)
    got = {r.g: r for r in boxes.collect()}
    for g, values in groups.items():
        values = np.round(values, 2)
        q1, med, q3 = np.quantile(values, [0.25, 0.5, 0.75])
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        want = [q1, med, q3, min(q1, inside.min()), max(q3, inside.max())]
        assert np.allclose([got[g].q1, got[g].med, got[g].q3, got[g].lo, got[g].hi], want)
        assert got[g].n == len(values)


def test_full_join_equals_a_chain_of_joins(inputs):
    t = inputs.annotation_tables()
    chain = None
    for source in ("GO", "IPR", "KEGG", "KOG"):
        part = genes.collapse_annotations(t[source], source)
        chain = part if chain is None else chain.join(part, "Protein_ID", "full")
    ours = genes.full_join_annotations(t["GO"], t["IPR"], t["KEGG"], t["KOG"])
    assert sorted(map(str, ours.collect())) == sorted(map(str, chain.select(ours.columns).collect()))


def test_counts_and_ranges(inputs):
    records = PA.parsed_records(inputs.vcf(), STUDY)
    alleles = calls.allele_call_counts(flatten.decompose_alleles(calls.genotypes(records)))
    total = records.agg(F.sum(F.size(F.split("ALT", ",")))).first()[0]
    assert alleles.count() == total
    assert alleles.filter("N_ALT_GTS > N_CALLS or N_CALLS > 25").count() == 0


def test_best_calls_first_or_both_sexes_first(spark, inputs):
    ranked = catalog._stored_ranked(inputs)
    args = (inputs.header_samples(), crosses.sample_index(inputs.samples()))
    good = PX.good_calls(ranked, *args, STUDY)
    ours = PX.kept_samples(ranked, *args, STUDY)
    other = crosses.top_samples(crosses.both_sexes(good), 2)
    assert sorted(map(str, ours.collect())) == sorted(map(str, other.select(ours.columns).collect()))
    pairs = {(r.F_ID, r.M_ID) for r in crosses.expand_crosses(ours).collect()}
    assert pairs and all(".F." in f and ".M." in m for f, m in pairs)


def test_stored_calls_give_the_same_crosses(inputs):
    records, table = inputs.vcf(), catalog._stored_genes(inputs)
    args = (inputs.header_samples(), crosses.sample_index(inputs.samples()), STUDY)
    listed = catalog._stored_sites(inputs)
    from_cells = PX.cross_table(PX.rank_variants(PX.calls_at(records, listed, STUDY), table, STUDY, False), *args)
    from_calls = PX.cross_table(PX.rank_variants(PX.split_calls(records, listed, STUDY), table, STUDY, False), *args)
    columns = ["Cross", "ROW_ID", "ALT_IDX", "ANN_IDX", "Comb_Rank"]
    assert sorted(map(str, from_cells.select(columns).collect())) == sorted(map(str, from_calls.select(columns).collect()))


def test_stage_runs_once_and_replaces_an_unfinished_write(spark):
    path = f"{shared_dir(spark)}/stage-{random.random()}"
    spark.range(3).write.parquet(path)
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).delete(marker, False)
    assert store.stage(spark, path, lambda: spark.range(5)).count() == 5
    assert store.stage(spark, path, lambda: spark.range(9)).count() == 5


def test_vcf_file_order_and_subset_written_back(spark, tmp_path):
    lines = ["##x", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t7\t8"]
    lines += [f"c\t{i}\t.\tA\tG\t{'.' if i % 2 else i}\tPASS\tAC=1\tGT\t0\t{i % 2}" for i in range(1000)]
    path = tmp_path / "a.vcf"
    path.write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4KB")
    try:
        rows = vcf.read_vcf(spark, str(path)).orderBy("ROW_ID").collect()
        assert [r.POS for r in rows] == list(range(1000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows[1].QUAL is None and rows[2].QUAL == 2.0 and rows[1].CELLS == ["0", "1"]
    assert [tuple(r) for r in vcf.vcf_samples(spark, str(path)).orderBy("SAMPLE_POS").collect()] == [(0, 7), (1, 8)]
    out = str(tmp_path / "b.vcf")
    subset = sites.subset_sites(vcf.read_vcf(spark, str(path)), spark.createDataFrame([("c", 5), ("c", 6)], "CHROM string, POS int"))
    vcf.write_vcf(subset, vcf.vcf_header(spark, str(path)), out)
    back = vcf.read_vcf(spark, out).orderBy("POS").drop("ROW_ID").collect()
    assert [(r.POS, r.QUAL, r.CELLS) for r in back] == [(5, None, ["0", "1"]), (6, 6.0, ["0", "0"])]
    assert vcf.vcf_header(spark, out).count() == 2


def test_stream_gives_the_same_rows(spark, inputs, tmp_path):
    folder = str(tmp_path / "in")
    vcf.to_lines(inputs.vcf()).write.text(folder)
    rows = flatten.explode_ann(PA.alleles(stream_vcf(spark, folder, genotypes=False), STUDY)).select("POS", "ALT", "Effect")
    query = rows.writeStream.format("memory").queryName("entries").start()
    query.processAllAvailable()
    query.stop()
    want = flatten.explode_ann(PA.alleles(sites.sites_only(inputs.vcf()), STUDY)).select("POS", "ALT", "Effect")
    assert sorted(map(str, spark.table("entries").collect())) == sorted(map(str, want.collect()))


def test_annotation_table_and_typed_reload(spark, tmp_path):
    path = tmp_path / "x_IPR.1.tab"
    path.write_text('#proteinId\tiprDesc\n1\t\\N\n1\t\n2\t"quoted"\n3\ta "b" c\n')
    rows = tables.read_annotation_table(spark, str(path), "IPR").orderBy("_row").collect()
    assert [(r.proteinId, r.iprDesc) for r in rows] == [("1", None), ("1", ""), ("2", "quoted"), ("3", 'a "b" c')]
    go = tmp_path / "x_GO.1.tab"
    go.write_text("#proteinId\tgoName\n1\tNA\n2\t\n3\tx\n")
    rows = tables.read_annotation_table(spark, str(go), "GO").orderBy("_row").collect()
    assert [r.goName for r in rows] == [None, None, "x"]
    assert tables.typed_schema({"a": "integer", "b": "odd"}).simpleString() == "struct<a:int,b:string>"


def test_report_form(spark, inputs):
    rows = PX.split_calls(inputs.vcf(), catalog._stored_sites(inputs), STUDY)
    wide = store.calls_wide(store.report_names(rows), list(range(101, 126)))
    assert "101_GT" in wide.columns and "125_PL_ALT" in wide.columns and "HGVS.c" in wide.columns
    assert wide.limit(1).collect()


def test_parameters_are_used(inputs):
    ranked = catalog._stored_ranked(inputs)
    args = (inputs.header_samples(), crosses.sample_index(inputs.samples()))
    strict = PX.good_calls(ranked, *args, Params(max_af=0.05, min_depth=20)).agg(F.max("AF"), F.min("DP_S")).first()
    assert strict[0] <= 0.05 and strict[1] >= 20


def test_order_over_files_of_unequal_size(spark, tmp_path):
    from varloom.sources import tables

    at = 0
    for name, size in (("a", 3), ("b", 900), ("c", 40)):
        lines = ["##x", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
        lines += [f"c\t{at + i}\t.\tA\tG\t.\tPASS\tAC=1" for i in range(size)]
        (tmp_path / f"{name}.vcf").write_text("\n".join(lines) + "\n")
        gff = [f"c\ts\tgene\t{at + i}\t{at + i}\t.\t+\t.\tID=g{at + i}" for i in range(size)]
        (tmp_path / f"{name}.gff").write_text("\n".join(gff) + "\n")
        at += size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2KB")
    try:
        rows = vcf.read_vcf(spark, str(tmp_path / "*.vcf"), genotypes=False).orderBy("ROW_ID").collect()
        features = tables.read_gff(spark, str(tmp_path / "*.gff")).orderBy("_row").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.POS for r in rows] == [r.Start for r in features] == list(range(at))
    assert [r._row for r in features] == list(range(at))


def test_text_sample_names_are_kept_or_refused(spark, tmp_path):
    import pytest

    path = tmp_path / "a.vcf"
    path.write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\t8\n")
    with pytest.raises(ValueError, match="s1"):
        vcf.vcf_samples(spark, str(path))
    assert [r.SampleID for r in vcf.vcf_samples(spark, str(path), numbers=False).collect()] == ["s1", "8"]


def test_tallies_do_not_read_genotypes(inputs):
    for tally in (sites.variant_counts, sites.variant_stats):
        text = plan(tally(inputs.vcf(), inputs.header_samples()))
        assert "CELLS" not in text


def test_a_whole_study_writes_its_reports(spark, inputs, tmp_path):
    from varloom.plans.study import Files, run_study
    from varloom.sources import tables

    text = catalog._vcf_text(inputs)
    inputs.gff().orderBy("_row").drop("_row").write.csv(str(tmp_path / "gff"), sep="\t", quote="")
    for source, table in inputs.annotation_tables().items():
        missing = "NA" if source == "GO" else "\\N"
        named = table.orderBy("_row").drop("_row").withColumnRenamed("proteinId", "#proteinId")
        named.coalesce(1).write.csv(str(tmp_path / f"set1_{source}.1.tab.gz"), sep="\t", header=True, nullValue=missing)
    inputs.curated().write.csv(str(tmp_path / "curated"), header=True)
    inputs.samples().write.csv(str(tmp_path / "metadata"), header=True)
    files = Files(text, str(tmp_path / "gff"), str(tmp_path), "set1", str(tmp_path / "curated"), str(tmp_path / "metadata"))
    paths = run_study(spark, files, str(tmp_path / "out"), STUDY)
    read = lambda name: spark.read.csv(paths[name], sep="\t", header=True)
    want = {tuple(r) for r in catalog.queries()["cross_list"](spark, "/root/testdata/sf0.001").select("Rank", "Cross").collect()}
    assert {(int(r.Rank), r.Cross) for r in read("cross_list").collect()} == want
    listed = catalog._stored_sites(inputs)
    assert spark.read.csv(paths["sites"], sep="\t").count() == listed.count()
    assert vcf.read_vcf(spark, paths["subset_vcf"]).count() == sites.subset_sites(inputs.vcf(), listed).count()
    assert tables.read_typed(spark, paths["split_annotations"], "CHROM string").count() == catalog._stored_split(inputs).count()


def test_listed_points_are_never_broadcast(spark):
    """Their files are far smaller than the rows that they become, so the size of the files says nothing."""
    folder = f"{shared_dir(spark)}/points-{random.random()}"
    spark.range(400).selectExpr("'s' || id % 3 as CHROM", "id * 211 as at").write.parquet(f"{folder}/points")
    spans = spark.range(900).selectExpr("id", "'s' || id % 4 as CHROM", "id * 97 as POS", "id * 97 + if(id % 50 = 7, 4000, id % 60) as last")
    spans.write.parquet(f"{folder}/spans")
    points, spans = spark.read.parquet(f"{folder}/points"), spark.read.parquet(f"{folder}/spans")
    found = intervals.covering(spans, points, "CHROM", "POS", "last", "at")
    listed = {}
    for p in points.collect():
        listed.setdefault(p.CHROM, []).append(p.at)
    want = {r.id for r in spans.collect() if any(r.POS <= at <= r.last for at in listed.get(r.CHROM, []))}
    assert 0 < len(want) < 900
    assert {r.id for r in found.collect()} == want
    # Once from the estimate, once from what was counted.
    assert "Broadcast" not in plan(found) and "SortMergeJoin" in plan(found)


def test_gene_tables_are_never_broadcast(inputs):
    """Their texts take several times the size of their files; at this size all of them would be broadcast."""
    gene = r"\[CHROM#\d+, Protein_ID#\d+, Gene_ID#\d+\]"
    for built in (
        PA.high_impact_sites(inputs.vcf(), catalog._stored_ids(inputs), catalog._stored_genes(inputs), STUDY),
        catalog._ranked(inputs),
    ):
        text = plan(built)
        assert re.search(rf"SortMergeJoin {gene}", text) and not re.search(rf"BroadcastHashJoin {gene}", text)
        # Of the listed sites, too, and of the proteins of interest.
        assert not re.search(r"BroadcastHashJoin \[(CHROM#\d+, _at#\d+\.level|Protein_ID#\d+\])", text)
