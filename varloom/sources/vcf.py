"""VCF text: header, samples, records, and writing records back."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.params import VCF_FIXED
from varloom.sources.blocks import read_block_lines
from varloom.sources.files import in_scan_order


def parse_lines(lines: DataFrame, genotypes: bool = True) -> DataFrame:
    """Records from raw lines (``value``); other columns of ``lines`` are kept.

    The line is cut at the ninth tab only, so that sites-only reads never split the samples.
    """
    rest = [c for c in lines.columns if c != "value"]
    body = lines.filter(~F.col("value").startswith("#"))
    cut = body.select(*rest, F.split("value", "\t", 10).alias("_f"))
    fields = [F.get("_f", F.lit(i)) for i in range(10)]
    columns = dict(zip(VCF_FIXED, fields))
    columns["POS"] = columns["POS"].try_cast("bigint")
    columns["QUAL"] = columns["QUAL"].try_cast("double")
    if genotypes:
        columns["FORMAT"] = fields[8]
        columns["CELLS"] = F.split(fields[9], "\t")
    return cut.select(*rest, *[c.alias(n) for n, c in columns.items()])


def read_vcf(
    spark: SparkSession, path: str, genotypes: bool = True, spread: bool = False, blocks: bool = False
) -> DataFrame:
    """Records of a VCF, plain or compressed, with ``ROW_ID`` that rises with file and line.

    One scan gives records and numbers, which have gaps, see :func:`in_scan_order`.
    A gzip file is one task, whatever its size, unless it is block-compressed, as indexed files are:
    ``blocks`` then reads it by as many tasks as a plain file of that size. ``spread`` deals lines of other
    gzip files out by their number right after the scan, over as many tasks as adaptive execution finds
    fit; write them to Parquet once and read that after.
    """
    numbered = read_block_lines(spark, path) if blocks else in_scan_order(spark.read.text(path), "ROW_ID")
    if spread:
        numbered = numbered.repartition("ROW_ID")
    return parse_lines(numbered, genotypes)


def vcf_header(spark: SparkSession, path: str, first: int = 1000) -> DataFrame:
    """Header lines of the first file, by path, in order: ``LINE`` and ``value``, the column line included.

    The header is where the file begins: growing numbers of lines are taken, from ``first`` on, until one
    is a record. The rest of the file is not read.
    """
    file = [unquote(f) for f in sorted(spark.read.text(path).inputFiles())[:1]]
    lines = spark.read.text(file).where(F.col("_metadata.file_block_start") == 0) if file else None
    taken, found = first, []
    while lines is not None:
        found = [r.value for r in lines.take(taken)]
        ends = next((i for i, line in enumerate(found) if not line.startswith("#")), None)
        if ends is not None or len(found) < taken:
            found = found[:ends]
            break
        taken *= 8
    return spark.createDataFrame(list(enumerate(found)), "LINE int, value string")


def vcf_samples(spark: SparkSession, path: str, numbers: bool = True) -> DataFrame:
    """Sample IDs at their place in the header: ``SAMPLE_POS, SampleID``.

    IDs are numbers; a name that is none is refused, unless ``numbers`` is off, which keeps IDs as text.

    Only the header of the first file is read, see :func:`vcf_header`.
    """
    line = vcf_header(spark, path).filter(F.col("value").startswith("#CHROM")).first()
    names = line["value"].split("\t")[9:] if line else []
    odd = [n for n in names if numbers and not n.isdecimal()]
    if odd:
        raise ValueError(f"sample names that are no numbers, such as {odd[0]}: read them with numbers=False")
    rows = spark.createDataFrame(list(enumerate(names)), "SAMPLE_POS int, SampleID string")
    return rows.withColumn("SampleID", F.col("SampleID").cast("bigint")) if numbers else rows


def to_lines(records: DataFrame) -> DataFrame:
    """Records as VCF text lines."""
    fields = [F.col(c).cast("string") for c in VCF_FIXED if c != "QUAL"]
    fields.insert(VCF_FIXED.index("QUAL"), F.coalesce(F.col("QUAL").cast("string"), F.lit(".")))
    if "CELLS" in records.columns:
        fields += [F.col("FORMAT"), F.array_join("CELLS", "\t")]
    return records.select(F.concat_ws("\t", *[F.coalesce(f, F.lit(".")) for f in fields]).alias("value"))


def write_vcf(records: DataFrame, header: DataFrame, path: str, compression: str = "none") -> None:
    """Write header lines and records; the header is the first part file.

    ``header`` holds the few lines of a file header, in order, or by ``LINE`` where it has that.
    """
    ordered = header.orderBy("LINE") if "LINE" in header.columns else header
    lines = ordered.select("value").coalesce(1).union(to_lines(records))
    lines.write.option("compression", compression).text(path)
