"""INFO keys as found, refusal in one pass, long spans, shared layouts, block files, chunked texts, best crosses."""

import gzip
import random
import zlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, Row
from pyspark.sql import functions as F

from varloom import catalog
from varloom.fixtures import STUDY
from varloom.operators import calls, crosses, flatten, genes, intervals, order, qc, sites, terms
from varloom.params import INFO_SCHEMA
from varloom.plans import annotations as PA
from varloom.plans import crosses as PX
from varloom.session import new_path
from varloom.sources import blocks, files, store, vcf
from varloom.streaming import tallies


def record(spark, info="AC=1", alt="G", row=1, cells=("0:1,2:3:4:5",), layout="GT:AD:DP:GQ:PL"):
    data = {"ROW_ID": row, "CHROM": "c", "POS": 10, "ID": ".", "REF": "A", "ALT": alt, "QUAL": 1.0, "FILTER": ".", "INFO": info}
    return spark.createDataFrame([Row(**data, FORMAT=layout, CELLS=list(cells))])


# ---- INFO --------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("info", "rest"),
    [
        ("AC=1;ZZ=x=y;DS;YY", '{"YY":true,"ZZ":"x=y"}'),
        ("AC=1;DS", None),
        ("", None),
        (".", None),
        (None, None),
        ("ZZ=", '{"ZZ":""}'),
        ("ZZ=1;ZZ=2", '{"ZZ":"2"}'),
    ],
)
def test_keys_outside_the_schema_are_kept(spark, info, rest):
    rows = spark.createDataFrame([(1, "G", info)], "ROW_ID int, ALT string, INFO string")
    parsed = flatten.parse_info(rows, INFO_SCHEMA, "more")
    assert parsed.select(F.to_json("more")).first()[0] == rest
    assert "more" not in flatten.parse_info(rows).columns


def test_the_remainder_reaches_the_reports(spark):
    entry = "|".join(["G", "stop_gained", "HIGH", "7", "gene_5", *["x"] * 11])
    rows = record(spark, info=f"AC=1;NEW=a;ANN={entry}")
    flat = PA.split_annotations(rows, STUDY)
    assert flat.select("INFO_REST").first()[0] == '{"NEW":"a"}'
    ranked = PX.high_calls(rows, STUDY)
    assert store.report_names(ranked).select("INFO_REST").first()[0] == '{"NEW":"a"}'


def test_discovered_schema(spark):
    infos = [("G", "A=1;B=0.5;C;D=7;E=1,2,3;F=x;AC=4;G=1e-3;H=99999999999"), ("G,T", "A=-2,3;B=1;D=8;E=1;F=1;G=2;H=1"), ("G", "A=5;C")]
    rows = spark.createDataFrame(infos, "ALT string, INFO string")
    found = flatten.discover_schema(rows, {"AC": ("int", "A")})
    assert found == {
        "AC": ("int", "A"), "A": ("int", "A"), "B": ("double", "1"), "C": ("boolean", "0"), "D": ("int", "1"), "E": ("string", "."),
        "F": ("string", "1"), "G": ("double", "1"), "H": ("double", "1"),
    }
    alleles = flatten.decompose_alleles(flatten.parse_info(rows, found), found)
    assert [r.A for r in alleles.filter("D = 8").orderBy("ALT_IDX").collect()] == [-2, 3]
    with pytest.raises(ValueError, match="more than 3"):
        flatten.discover_schema(rows, {}, most=3)


def test_key_counts_combine_before_the_shuffle(inputs):
    plan = flatten.info_keys(catalog._sites(inputs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(Key") == 1 and plan.count("partial_count") >= 1


# ---- refusal -----------------------------------------------------------------------------------

ANN = "|".join(["G", "stop_gained", "HIGH", "7", "gene_5", *["x"] * 11])


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"cells": ["0:1,2:3:4:5", "1:3,4"]}, "another number of fields"),
        ({"cells": ["0:1,2:3:4:5:9"]}, "another number of fields"),
        ({"cells": ["0:1,2:3:4:5"], "layout": "GT:DP"}, "another number of fields"),
        ({"cells": ["0:3:4"], "layout": "GT:DP:GQ:AD"}, "another number of fields"),
        ({"info": f"AC=1,2,3,4;ANN={ANN}"}, "AC"),
        ({"info": f"AC=1;AF=1,2;ANN={ANN}", "alt": "G,T,C"}, "AF"),
        ({"info": f"AC=1;ANN={ANN},G|x"}, "expected 16"),
    ],
)
def test_malformed_records_end_the_job_or_are_counted(spark, change, message):
    rows = record(spark, **{"info": f"AC=1;ANN={ANN}"} | change)
    assert PX.high_calls(record(spark, info=f"AC=1;ANN={ANN}"), STUDY).count() == 1
    listed = spark.createDataFrame([("c", 10)], "CHROM string, POS bigint")
    with pytest.raises(PySparkException, match=message):
        PX.split_calls(rows, listed, STUDY).write.format("noop").mode("overwrite").save()
    lenient = type(STUDY)(**{**STUDY.__dict__, "mode": "permissive"})
    PX.split_calls(rows, listed, lenient).write.format("noop").mode("overwrite").save()
    parsed = PA.parsed_records(rows, lenient)
    kept, bad, counts = flatten.route_records(parsed, new_path(spark, "routed"))
    assert (kept.count(), bad.count(), counts["records"]) == (1, 1, 1) and sum(counts.values()) == 2
    with pytest.raises(PySparkException, match="malformed record at c:10"):
        flatten.route_records(parsed, new_path(spark, "routed"), mode="failfast")


@pytest.mark.parametrize(("layout", "cell"), [("GT:AD:DP:GQ:PL", "1:3,4:5:6:7,8"), ("GQ:PL:GT:AD:DP", "6:7,8:1:3,4:5"), ("GT:DP", "1:5"), ("GT:X:AD:DP:Y:GQ:PL", "1::3,4:5::6:7,8")])
def test_cells_of_any_format(spark, layout, cell):
    want = (1, "3,4", 5, 6, "7,8") if "PL" in layout else (1, None, 5, None, None)
    rows = record(spark, cells=[cell, cell], layout=layout)
    for call in calls.parse_calls(rows, by_format=True, mode="failfast").first().CALLS:
        assert tuple(call) == want
    samples = spark.createDataFrame([(0, 1), (1, 2)], "SAMPLE_POS int, SampleID bigint")
    for row in calls.cells_long(rows, samples, by_format=True, mode="failfast").collect():
        assert (row.GT, row.AD, row.DP_S, row.GQ, row.PL) == want


def test_counters_need_no_pass_of_their_own(spark, inputs):
    rows = catalog._spoilt(PA.parsed_records(inputs.vcf(), STUDY))
    counts = Observation("passing")
    flatten.observed(rows, counts).write.format("noop").mode("overwrite").save()
    bad = flatten.bad_records(rows).select("Reason").collect()
    assert counts.get["records"] == inputs.vcf().count()
    for fault in ("AC length", "ANN fields", "LOF fields", "cell fields"):
        assert counts.get[fault] == sum(fault in r.Reason.split(", ") for r in bad) > 0
    # Malformed rows are put aside by the write that stores all of them.
    path = new_path(spark, "routed")
    plan = flatten.route_records(rows, path)[1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(malformed" in plan


# ---- spans -------------------------------------------------------------------------------------


def spans(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = rng.randrange(1, 3_000_000)
        rows.append((i, rng.choice("ab"), start, start + rng.choice([0, 0, 1, 5, 127, 128, 1023, 1024, 9_000, 70_000, 1_000_000, 1 << 31, 1 << 33])))
    return spark.createDataFrame(rows + [(n, "a", None, 5), (n + 1, None, 1, 5)], "id int, k string, s bigint, e bigint"), rows


def test_spans_find_their_points(spark):
    table, rows = spans(spark, 400, 1)
    rng = random.Random(2)
    points = [(rng.choice("ab"), rng.choice([rng.randrange(3_000_000), rng.randrange(400) * 8192, 1 << 32])) for _ in range(500)]
    listed = spark.createDataFrame([*points, points[0], ("a", None)], "k string, p bigint")
    found = {r.id for r in intervals.covering(table, listed, "k", "s", "e", "p").collect()}
    assert found == {i for i, k, s, e in rows if any(k == q and s <= p <= e for q, p in points)}
    most = table.select(F.size(intervals.span_bins(F.col("s"), F.col("e"))).alias("n")).agg(F.max("n")).first()[0]
    assert most == 2
    thin = intervals.thinned(listed, "k", "p").groupBy("k", "level", "bin").count()
    assert thin.filter("level > 0").agg(F.max("count")).first()[0] <= 2 << intervals.PARTS


def test_dense_points_do_not_make_hot_bins(spark):
    dense = spark.range(200_000).select(F.lit("a").alias("k"), F.col("id").alias("p"))
    thin = intervals.thinned(dense, "k", "p")
    assert thin.groupBy("k", "level", "bin").count().agg(F.max("count")).first()[0] <= 128
    assert thin.count() < 2 * 200_000


def test_overlaps_come_once(spark):
    left, a = spans(spark, 150, 3)
    right, b = spans(spark, 150, 4)
    other = right.toDF("other", "k", "s2", "e2")
    found = sorted((r.id, r.other) for r in intervals.overlaps(left, other, "k", ("s", "e"), ("s2", "e2")).collect())
    assert found == sorted((i, j) for i, k, s, e in a for j, q, t, f in b if k == q and s <= f and t <= e)


def test_records_of_a_megabase(spark):
    long = "A" * 1_000_000
    rows = [(0, "c", 500, long, "A", "AC=1"), (1, "c", 500, "A", "<DEL>", "END=1000500;AC=1"), (2, "c", 500, "A", "T", "XEND=99999999"), (3, "c", 2_000_000, "A", "T", None)]
    table = spark.createDataFrame(rows, "ROW_ID int, CHROM string, POS bigint, REF string, ALT string, INFO string")
    for position, want in ((1_000_499, {0, 1}), (1_000_500, {1}), (500, {0, 1, 2}), (2_000_000, {3}), (1_500_000, set())):
        listed = spark.createDataFrame([("c", position)], "CHROM string, POS bigint")
        assert {r.ROW_ID for r in sites.subset_sites(table, listed).collect()} == want


# ---- one layout --------------------------------------------------------------------------------


def test_joins_by_site_share_the_stored_layout(spark, inputs):
    listed = catalog._stored_sites(inputs)
    subset = PX.store_subset(inputs.vcf(), listed)
    want = PX.high_calls(sites.subset_sites(inputs.vcf(), listed), STUDY).select("ROW_ID", "ALT", "ANN_IDX", "isLOF", "isNMD", "N_ALT_GTS", "ALT_SUMMARY")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = PX.high_calls(subset, STUDY)
        plan = found._jdf.queryExecution().executedPlan().toString()
        # LOF, NMD and the site summary, in the summary and in the rows.
        assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan
        some = found.select(*want.columns).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(str, some)) == sorted(map(str, want.collect()))


def test_cells_are_scanned_once(spark, inputs):
    subset = PX.store_subset(inputs.vcf(), catalog._stored_sites(inputs))
    rows = PX.high_calls(subset, STUDY)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 6
    scans = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert sum("CELLS" in line for line in scans) == 2  # counts of all rows, cells of the high ones


# ---- block files -------------------------------------------------------------------------------


def blocked(text, size):
    out = b""
    for i in range(0, len(text), size):
        part, packer = text[i : i + size], zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(part) + packer.flush()
        out += blocks.HEAD + (25 + len(body)).to_bytes(2, "little") + body + zlib.crc32(part).to_bytes(4, "little") + len(part).to_bytes(4, "little")
    return out + blocks.EMPTY


@pytest.fixture
def small_ranges(spark):
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_block_files_read_as_the_plain_scan_does(spark, tmp_path, small_ranges):
    rng = random.Random(1)
    lines = ["".join(rng.choices("abcdefghé\t", k=rng.choice([0, 3, 50, 900]))) for _ in range(1500)]
    noise = "".join(rng.choices("abcdefgh", k=100_000))
    contents = {
        "b": "\n".join(lines).encode(),
        "a": ("\n".join(lines[:50]) + "\n").encode(),
        # A line over many ranges, ends of two characters, empty lines, a line without an end.
        "c": ("x" * 100_000 + noise + "\r\n\n\ny").encode(),
        "d": b"",
        "e": b"\n",
        # What begins a block, inside of one.
        "f": blocks.HEAD * 50 + b"\n" + bytes(rng.choices(range(32, 120), k=60_000)) + b"\n",
    }
    for name, text in contents.items():
        (tmp_path / f"{name}.vcf.gz").write_bytes(blocked(text, rng.choice([700, 3000, 20_000])))
    got = blocks.read_block_lines(spark, str(tmp_path))
    want = files.in_file_order(spark.read.text(str(tmp_path)), "ROW_ID")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert blocks._raw_blocks(spark, str(tmp_path / "c.vcf.gz")).rdd.getNumPartitions() > 2
    one = blocks.read_block_lines(spark, str(tmp_path / "a*.gz"))
    assert [r.value for r in one.orderBy("ROW_ID").collect()] == lines[:50]


def test_written_blocks_are_gzip(spark, tmp_path):
    lines = spark.range(20_000).select(F.concat(F.lit("line é "), F.col("id")).alias("value"))
    path = str(tmp_path / "out")
    blocks.write_block_lines(lines.coalesce(2), path)
    assert sorted(r.value for r in blocks.read_block_lines(spark, path).collect()) == sorted(r.value for r in lines.collect())
    text = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "out").glob("part-*")))
    assert text.decode().splitlines() == [f"line é {i}" for i in range(20_000)]


@pytest.mark.parametrize("spoil", [lambda b: b"no blocks at all\n" + b, lambda b: b[:-40], lambda b: b[:40] + bytes([b[40] ^ 255]) + b[41:], lambda b: gzip.compress(b"x")])
def test_damaged_blocks_end_the_job(spark, tmp_path, spoil):
    (tmp_path / "x.vcf.gz").write_bytes(spoil(blocked(b"some text\n" * 5000, 3000)))
    with pytest.raises(PySparkException):
        blocks.read_block_lines(spark, str(tmp_path / "x.vcf.gz")).count()


# ---- chunked texts -----------------------------------------------------------------------------


def test_a_protein_with_a_million_names(spark):
    n = 1_000_000
    names = spark.range(n).select(F.lit(7).alias("proteinId"), F.col("id").alias("_row"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("n"), F.col("id"))).alias("definition"))
    text = genes.collapse_annotations(names.repartition(8), "KEGG").first().KEGG
    assert text == ";".join(f"n{i}" for i in range(n) if i % 10)
    # The lists that are built hold a chunk of rows, or the chunks.
    assert max(genes.COLLAPSE_CHUNK, n // genes.COLLAPSE_CHUNK) < n / 200


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_chunks_keep_order_and_missing_values(spark, chunk):
    rows = [("a", i, None if i % 3 == 0 else f"t{i % 5}") for i in range(20)] + [("b", 5, None), ("c", 9, ""), ("c", 8, "x")]
    table = spark.createDataFrame(rows, "k string, at int, t string").repartition(5)
    got = order.ordered_text(table, ["k"], ["at"], {"text": F.col("t")}, ";", F.floor(F.col("at") / chunk))
    want = {"a": ";".join(t for _, _, t in rows[:20] if t is not None), "b": "", "c": "x;"}
    assert {r.k: r.text for r in got.collect()} == want


def test_summary_in_chunks(inputs):
    rows = PX.call_rows(inputs.vcf(), STUDY).withColumns({"POS": F.col("POS") % 3, "CHROM": F.lit("c")}).select("ROW_ID", "CHROM", "POS", "REF", "ALT", "ALT_IDX", "ANN_IDX", "N_ALT_GTS")
    whole, parts = (calls.site_allele_summary(rows, n).orderBy("POS").collect() for n in (1 << 40, 7))
    assert whole == parts and len(whole) == 3


# ---- best crosses ------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 7, 40, 10_000])
def test_best_crosses_are_the_first_of_the_list(inputs, n):
    kept = PX.kept_samples(catalog._stored_ranked(inputs), inputs.header_samples(), catalog._samples(inputs), STUDY)
    whole = crosses.cross_list(crosses.expand_crosses(kept)).orderBy("Rank").collect()
    seen = []
    best = crosses.best_crosses(kept, n, seen)
    assert best.orderBy("Rank").collect() == whole[:n]
    if n <= 7:
        assert max(seen) < kept.select("ROW_ID", "ALT_IDX", "ANN_IDX").distinct().count()


# ---- terms -------------------------------------------------------------------------------------


def test_terms_of_any_number_and_length(spark):
    rng = random.Random(4)
    texts = [(i, "".join(rng.choices("abAB é%_", k=rng.choice([0, 1, 2, 5, 40])))) for i in range(300)] + [(301, None)]
    wanted = ["".join(rng.choices("abAB é%_", k=rng.choice([1, 2, 3, 4, 6]))) for _ in range(200)] + ["", None, "zzzz", "z"]
    table, listed = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame([(w,) for w in wanted], "term string")
    found = sorted((r.id, r.term) for r in terms.matches(table, listed, ["id"], "t").collect())
    assert found == sorted({(i, w) for i, t in texts for w in wanted if t and w and w.lower() in t.lower()})
    assert terms.matches(table, listed.limit(0), ["id"], "t").count() == 0
    assert terms.matches(table.limit(0), listed, ["id"], "t").count() == 0


def test_many_terms_find_what_the_few_do(inputs, spark):
    kegg = inputs.annotation_tables()["KEGG"]
    many = spark.range(50_000).select(F.concat(F.lit("no such term "), "id").alias("term")).union(spark.createDataFrame([(t,) for t in STUDY.search_terms], "term string"))
    found = terms.matches(kegg.select(F.col("proteinId").cast("string").alias("p"), "definition"), many, ["p"], "definition")
    want = genes.search_terms(kegg, "KEGG")
    assert {r.p for r in found.collect()} == {r.Protein_ID for r in want.collect()} != set()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# ---- stages, tallies, sketches -----------------------------------------------------------------


def test_stages_follow_their_inputs(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "stages")
    count = lambda: len(list((tmp_path / "stages").iterdir()))

    def stage(factor=2):
        return store.stage_by_content(spark.read.parquet(source).select((F.col("id") * factor).alias("x")), folder, "doubled").agg(F.sum("x")).first()[0]

    spark.range(10).write.parquet(source)
    assert (stage(), count()) == (90, 1)
    assert (stage(), count()) == (90, 1)
    assert (stage(3), count()) == (135, 2)
    spark.range(5).write.mode("append").parquet(source)
    assert (stage(), count()) == (110, 3)
    assert (stage(3), stage(), count()) == (165, 110, 4)


def test_batches_count_once(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    runs = []

    def partial(batch):
        runs.append(1)
        return batch.groupBy("value").agg(F.count("*").alias("n"))

    def totals():
        tallies.fold(spark.readStream.text(folder), out, partial)
        return {r.value: r.n for r in tallies.summed(tallies.folded(spark, out), ["value"], ["n"]).collect()}

    spark.createDataFrame([("a",), ("b",), ("a",)], "value string").write.text(folder)
    assert totals() == {"a": 2, "b": 1}
    assert totals() == {"a": 2, "b": 1} and len(runs) == 1
    spark.createDataFrame([("a",), ("c",)], "value string").write.mode("append").text(folder)
    assert totals() == {"a": 3, "b": 1, "c": 1} and len(runs) == 2
    # A batch that failed after it was stored runs again under its number.
    (tmp_path / "out" / "progress" / "commits" / "1").unlink()
    (tmp_path / "out" / "progress" / "commits" / ".1.crc").unlink(missing_ok=True)
    assert totals() == {"a": 3, "b": 1, "c": 1} and len(runs) == 3


@pytest.mark.parametrize("k", [64, 512])
def test_merged_sketches_keep_their_rank_bound(spark, k):
    rng = random.Random(k)
    values = [rng.lognormvariate(0, 2) for _ in range(60_000)]
    rows = spark.createDataFrame([("e", v) for v in values] + [("e", None), ("e", float("nan")), ("f", 1.0)], "by string, AF double")
    parts = [qc.box_sketches(rows.filter(F.pmod(F.xxhash64("AF"), F.lit(5)) == i), "by", ["AF"], k) for i in range(5)]
    sketches = parts[0]
    for part in parts[1:]:
        sketches = sketches.unionByName(part)
    boxes = {r.by: r for r in qc.boxes_of_sketches(sketches, "by").collect()}
    box = boxes["e"]
    assert (box.n, box.least, box.most) == (len(values), min(values), max(values))
    for q, p in (("q1", 0.25), ("med", 0.5), ("q3", 0.75)):
        assert abs(sum(v <= box[q] for v in values) / len(values) - p) <= qc.rank_error(k) + 1 / len(values)
    assert (boxes["f"].q1, boxes["f"].q3, boxes["f"].n) == (1.0, 1.0, 1)


# ---- scans -------------------------------------------------------------------------------------


def test_records_and_their_numbers_come_from_one_scan(spark, tmp_path, small_ranges):
    lines = [f"c\t{i}\t.\tA\tG\t.\tPASS\tAC=1" for i in range(4000)]
    for name, part in (("a b", lines[:10]), ("b", lines[10:3000]), ("c", lines[3000:])):
        (tmp_path / f"{name}.vcf").write_text("##x\n#CHROM\n" + "\n".join(part) + "\n")
    one = vcf.read_vcf(spark, str(tmp_path / "b.vcf"), genotypes=False)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Exchange" not in plan
    rows = vcf.read_vcf(spark, str(tmp_path), genotypes=False)
    assert rows.rdd.getNumPartitions() > 3
    assert [r.POS for r in rows.orderBy("ROW_ID").collect()] == list(range(4000))
    assert rows.select("ROW_ID").distinct().count() == 4000
    head = vcf.vcf_header(spark, str(tmp_path), first=1)
    assert [(r.LINE, r.value) for r in head.orderBy("LINE").collect()] == [(0, "##x"), (1, "#CHROM")]


def test_empty_tables_read_as_such(spark, tmp_path):
    from varloom.sources import tables

    (tmp_path / "x_KEGG.tab").write_text("")
    assert tables.read_annotation_table(spark, str(tmp_path / "x_KEGG.tab"), "KEGG").columns == ["_row", "proteinId", "definition"]
