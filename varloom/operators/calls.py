"""Genotype calls: per-record arrays first, long rows only for the samples that matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions.genotype import call_columns, call_places, present, ref_alt_columns
from varloom.functions.text import separators
from varloom.operators.flatten import check_mode, refused
from varloom.params import CALL_FIELDS

# Records of one site whose rows are put together at a time.
SUMMARY_CHUNK = 1 << 12


def _refuse_cells(records: DataFrame, cells: Column, mode: str, by_format: bool) -> Column:
    """``cells``; in failfast mode the job ends at a record with a cell of another number of fields than FORMAT."""
    check_mode(mode)
    if mode != "failfast":
        return cells
    want = separators(F.col("FORMAT"), ":") if by_format and "FORMAT" in records.columns else F.lit(len(CALL_FIELDS) - 1)
    # Cells may not be there at all.
    bad = F.coalesce(F.exists("CELLS", lambda cell: separators(cell, ":") != want), F.lit(False))
    where = F.concat_ws(":", *[F.col(c) for c in ("CHROM", "POS") if c in records.columns])
    return refused(bad, F.concat(F.lit("a cell with another number of fields than its FORMAT at "), where), cells)


def genotypes(records: DataFrame, mode: str = "permissive", by_format: bool = True) -> DataFrame:
    """Add ``GTS``, the called allele of each sample, NULL where missing, and ``N_CALLS``, the samples called.

    GT leads every cell that has it. In failfast mode a cell of another number of fields than FORMAT ends
    the job.
    """
    first = F.transform(_refuse_cells(records, F.col("CELLS"), mode, by_format), lambda cell: F.substring_index(cell, ":", 1))
    # A failing cast is slow, so the usual missing value is sorted out before it.
    called = records.withColumn("GTS", F.transform(first, lambda gt: present(gt).try_cast("int")))
    return called.withColumn("N_CALLS", F.size(F.array_compact("GTS")))


def allele_call_counts(alleles: DataFrame) -> DataFrame:
    """Add ``N_ALT_GTS``, the samples that carry the row's allele."""
    return alleles.withColumn("N_ALT_GTS", F.size("GTS") - F.size(F.array_remove("GTS", F.col("ALT_IDX"))))


def parse_calls(records: DataFrame, by_format: bool = False, mode: str = "permissive") -> DataFrame:
    """Replace ``CELLS`` with ``CALLS``: one struct of typed fields per sample, header order.

    With ``by_format`` the fields are where the record's FORMAT says. In failfast mode a cell of another
    number of fields ends the job.
    """

    def typed(parts: Column, places: Column | None = None) -> Column:
        return F.struct(*[c.alias(n) for n, c in call_columns(parts, places).items()])

    cells = _refuse_cells(records, F.col("CELLS"), mode, by_format)
    if by_format:
        # The list of one element binds the places, which are then looked up once per record.
        each = F.transform(
            F.array(call_places(F.col("FORMAT"))), lambda at: F.transform(cells, lambda cell: typed(F.split(cell, ":"), at))
        )
        parsed = F.get(each, F.lit(0))
    else:
        parsed = F.transform(cells, lambda cell: typed(F.split(cell, ":")))
    rest = [c for c in records.columns if c != "CELLS"]
    return records.select(*rest, parsed.alias("CALLS"))


def ref_alt_depth(records: DataFrame) -> DataFrame:
    """Add AD_REF, AD_ALT, PL_REF and PL_ALT to each struct of ``CALLS``."""

    def extended(call: Column) -> Column:
        kept = [call[n].alias(n) for n in ("GT", "AD", "DP_S", "GQ", "PL")]
        more = ref_alt_columns(call["GT"], call["AD"], call["PL"])
        return F.struct(*kept, *[c.alias(n) for n, c in more.items()])

    return records.withColumn("CALLS", F.transform("CALLS", extended))


def calls_long(calls: DataFrame, header_samples: DataFrame) -> DataFrame:
    """One row per variant row and sample; drops the AD and PL lists.

    ``header_samples`` gives the SampleID at each place of the header (``SAMPLE_POS, SampleID``).
    """
    rest = [c for c in calls.columns if c != "CALLS"]
    rows = calls.select(*rest, F.posexplode("CALLS").alias("SAMPLE_POS", "_call"))
    rows = rows.select(*rest, "SAMPLE_POS", "_call.*").drop("AD", "PL")
    return rows.join(header_samples, "SAMPLE_POS")


def cells_long(
    records: DataFrame, header_samples: DataFrame | None, by_format: bool = False, mode: str = "permissive"
) -> DataFrame:
    """:func:`parse_calls`, :func:`ref_alt_depth` and :func:`calls_long` in one, keeping AD and PL.

    The cells are exploded as text and split as columns, which runs as generated code; the places of
    the fields are found before that, once per record. Without ``header_samples`` there is no SampleID.
    """
    rest = [c for c in records.columns if c != "CELLS"]
    places = [call_places(F.col("FORMAT")).alias("_places")] if by_format else []
    cells = _refuse_cells(records, F.col("CELLS"), mode, by_format)
    rows = records.select(*rest, *places, F.posexplode(cells).alias("SAMPLE_POS", "_cell"))
    kept = [*rest, *(["_places"] if by_format else []), "SAMPLE_POS"]
    rows = rows.select(*kept, F.split("_cell", ":").alias("_parts"))
    rows = rows.withColumns(call_columns(F.col("_parts"), F.col("_places") if by_format else None)).drop("_parts", "_places")
    rows = rows.withColumns(ref_alt_columns(F.col("GT"), F.col("AD"), F.col("PL")))
    return rows if header_samples is None else rows.join(header_samples, "SAMPLE_POS")


def site_allele_summary(rows: DataFrame, chunk_records: int = SUMMARY_CHUNK) -> DataFrame:
    """Per (CHROM, POS): ``N_ALT_ALLELES``, the number of annotation rows, ``N_ALT_DISTINCT``, the
    number of alleles, and ``ALT_SUMMARY``, the text ``n:REF>ALT, ...`` in row order.

    Everything is first put together for the rows of ``chunk_records`` records of a site, then for the
    site, so that no list holds the rows of a site that many records share. The text lists every row of its
    site, so its size is that of the site; it is not built where it is not selected.
    """
    order = [c for c in ("ROW_ID", "ALT_IDX", "ANN_IDX") if c in rows.columns]
    label = F.concat(F.col("N_ALT_GTS"), F.lit(":"), F.col("REF"), F.lit(">"), F.col("ALT"))
    entry = F.struct(*order, label.alias("label"))
    chunk = F.floor(F.col("ROW_ID") / chunk_records) if "ROW_ID" in order else F.lit(0)
    some = rows.groupBy("CHROM", "POS", chunk.alias("_chunk")).agg(
        F.count("*").alias("_n"),
        F.collect_set(F.concat_ws(">", "REF", "ALT")).alias("_alleles"),
        F.array_join(F.array_sort(F.collect_list(entry))["label"], ", ").alias("_text"),
    )
    texts = F.array_sort(F.collect_list(F.struct("_chunk", "_text")))["_text"]
    return some.groupBy("CHROM", "POS").agg(
        F.sum("_n").cast("int").alias("N_ALT_ALLELES"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_alleles")))).alias("N_ALT_DISTINCT"),
        F.array_join(texts, ", ").alias("ALT_SUMMARY"),
    )


def filter_calls(
    calls: DataFrame,
    n_samples: Column,
    max_af: float = 0.15,
    min_call_rate: float = 0.8,
    min_depth: int = 10,
    min_quality: int = 20,
) -> DataFrame:
    """Keep good calls of the row's own allele where that allele is rare and the site well called."""
    return calls.filter(
        (F.col("GT") == F.col("ALT_IDX"))
        & (F.col("AF") <= max_af)
        & (F.col("N_CALLS") / n_samples >= min_call_rate)
        & (F.col("DP_S") >= min_depth)
        & (F.col("GQ") >= min_quality)
    )


def drop_singletons(variants: DataFrame, min_alt_genotypes: int = 2) -> DataFrame:
    """Keep alleles that at least ``min_alt_genotypes`` samples carry."""
    return variants.filter(F.col("N_ALT_GTS") >= min_alt_genotypes)
