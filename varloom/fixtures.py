"""Variant data derived from whole benchmark tables.

The benchmark tables hold no variants. Each order becomes a VCF record, each part a gene, each
nation a sequenced sample; gene-function names come from part, customer and orders, and the
curated list from supplier. Every table is used whole, and no two tables are crossed: the sample
columns of a record are computed from the record itself, as many as the sample table has rows.

The view texts are common to Spark and DuckDB. ``vcf`` and ``gff`` are raw text fields, which the
engine parses; the ``exp_*`` views hold the same facts as columns and serve the SQL checks.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from varloom.params import Params
from varloom.session import configure, new_path

ANN_PREFIX = "db.p|Gnm1|"
LIST_PREFIX = "db.p_Gnm1_"
STUDY = Params(
    ann_prefix=ANN_PREFIX,
    list_prefix=LIST_PREFIX,
    product_overrides={"9000007": "patched product (Exo1)"},
)

#: Positions that records with an END reach beyond their own.
LONG_SPAN = 1_000_000

_BASE = "substr('ACGT', cast(k % 4 as int) + 1, 1)"
_OTHER = "substr('CGTA', cast(k % 4 as int) + 1, 1)"
_THIRD = "substr('GTAC', cast(k % 4 as int) + 1, 1)"


def _effect(i: int) -> str:
    return f"""case (k + {i}) % 9 when 0 then 'stop_gained&splice_region_variant' when 1 then 'frameshift_variant'
 when 2 then 'stop_lost' when 3 then 'conservative_inframe_deletion' when 4 then 'splice_acceptor_variant&intron_variant'
 when 5 then 'intron_variant' when 6 then '5_prime_UTR_variant' when 7 then 'start_lost' else 'synonymous_variant' end"""


def _impact(i: int) -> str:
    return f"""case when (k + {i}) % 9 in (0, 1, 2, 4, 7) then 'HIGH' when (k + {i}) % 9 = 3 then 'MODERATE'
 when (k + {i}) % 9 = 8 then 'LOW' else 'MODIFIER' end"""


_DEBUG = """case when k % 6 = 0 then 'WARNING_TRANSCRIPT_NO_START_CODON'
 when k % 10 = 1 then 'INFO_REALIGN_3_PRIME&WARNING_TRANSCRIPT_INCOMPLETE' else '' end"""
_HGVS = "case when k % 3 = 0 then '' else 'c.' || cast(k as string) || 'A>G' end"


def _entries(i: int) -> list[dict[str, str]]:
    """The ANN entries an allele may have: its fields, and when it has them."""
    alt = f"ALT{i}"
    has = f"{alt} is not null and {alt} <> '*'"
    own = {"alt": alt, "gene": "g", "debug": _DEBUG, "hgvs": _HGVS, "dist": "''"}
    return [
        own | {"effect": _effect(i), "impact": _impact(i), "when": has},
        own | {"effect": "'intron_variant'", "impact": "'MODIFIER'", "when": f"{has} and k % 4 = 0"},
        own
        | {
            "effect": "'upstream_gene_variant'",
            "impact": "'MODIFIER'",
            "gene": "(g + 1)",
            "hgvs": "''",
            "dist": "cast(k % 5000 as string)",
            "when": f"{has} and k % 6 = 0",
        },
        # Differs from the first entry in its message only.
        own | {"effect": _effect(i), "impact": _impact(i), "debug": "'INFO_SECOND_CALL'", "when": f"{has} and k % 14 = 0"},
    ]


def _entry_text(e: dict[str, str]) -> str:
    return (
        f"case when {e['when']} then {e['alt']} || '|' || {e['effect']} || '|' || {e['impact']} || '|{ANN_PREFIX}'"
        f" || cast(9000000 + {e['gene']} as string) || '|gene_' || cast({e['gene']} as string)"
        f" || '|transcript|mRNA_' || cast({e['gene']} as string) || '|protein_coding|1/3|' || {e['hgvs']}"
        f" || '|p.' || cast(k % 50 as string) || '|10/900|8/800|3/266|' || {e['dist']} || '|' || {e['debug']} end"
    )


def _lof_text(n: str, pct: str) -> str:
    return f"'({LIST_PREFIX}' || cast(9000000 + g as string) || '|gene_' || cast(g as string) || '|{n}|{pct})'"


# When a record has LOF and NMD entries: (condition, transcripts, share).
_LOF = [("(k + 1) % 9 in (0, 1, 4, 7) and k % 3 <> 0", "1", "1.00"), ("(k + 1) % 9 in (0, 1, 4, 7) and k % 3 <> 0 and k % 8 = 0", "2", "0.50")]
_NMD = [("(k + 1) % 9 in (0, 1) and k % 5 = 1", "1", "0.75")]


def _list_text(entries: list[tuple[str, str, str]]) -> str:
    return "concat_ws(',', " + ", ".join(f"case when {w} then {_lof_text(n, p)} end" for w, n, p in entries) + ")"


def _per_alt(one: str, two: str) -> str:
    return f"{one} || case when ALT2 is not null then ',' || {two} else '' end"


_AC1, _AC2 = "cast(1 + k % 9 as string)", "cast(1 + k % 4 as string)"
_AF1, _AF2 = "'0.' || lpad(cast((k * 13 + 1) % 40 as string), 2, '0')", "'0.' || lpad(cast((k * 13 + 2) % 40 as string), 2, '0')"
_QD = "case when k % 8 <> 5 then cast(k % 30 as string) || '.5' end"
_RAW = "case when k % 6 = 1 then cast(3600 + k % 10 as string) || ',30' end"
# Keys that no schema declares: a number and a flag.
_UNDECLARED = "case when k % 12 = 4 then ';LENG=' || cast(k % 7 as string) || case when k % 24 = 4 then ';NOVEL' else '' end else '' end"
_LAST = "(select max(n_nationkey) from nation)"

_MISSING = "((k * 31 + s * 17) % 23 = 22 or (k % 17 = 3 and s % 3 = 0))"
_CELL = {
    "GT": f"""case when {_MISSING} then '.' when (k * 31 + s * 17) % 23 in (0, 1) or (k * 7 + s * s) % 19 = 3 then '1'
 when (k * 31 + s * 17) % 23 = 2 and ALT2 is not null then '2' else '0' end""",
    "AD": f"""case when {_MISSING} or (k + s) % 31 = 0 then '.' else cast((k + 2 * s) % 30 as string) || ',' ||
 cast((3 * k + s) % 25 as string) || case when ALT2 is not null then ',' || cast((5 * k + s) % 20 as string) else '' end end""",
    "DP": "case when (k + s) % 29 = 0 then '.' else cast((k + s * 3) % 40 as string) end",
    "GQ": "case when (k + s) % 37 = 0 then '.' else cast((k * 7 + s * 5) % 99 as string) end",
    "PL": f"""case when {_MISSING} then '.' else cast((k + s) % 90 as string) || ',' || cast((k + 4 * s) % 70 as string)
 || case when ALT2 is not null then ',' || cast((2 * k + s) % 60 as string) else '' end end""",
}


def _place(entries: list[tuple[int, int, dict[str, str]]], at: int) -> str:
    """Place of entry ``at`` in the list of its record: the entries before it that the record has, and one."""
    return " + ".join(["1", *(f"case when {e['when']} then 1 else 0 end" for _, _, e in entries[:at])])


def _union(parts: list[str]) -> str:
    return "\nunion all ".join(parts)


def _views() -> dict[str, str]:
    both = [(1, "ALT1"), (2, "ALT2")]
    entries = [(i, n, e) for i, _ in both for n, e in enumerate(_entries(i))]
    feature = "'scaffold_' || cast(p_partkey % 10 as string) as CHROM, 'src' as Source"
    span = (
        "p_partkey * 1000 + 1 as feature_start, p_partkey * 1000 + 900 as feature_end, '.' as Score,"
        " case when p_partkey % 2 = 0 then '+' else '-' end as Strand"
    )
    key = "cast(p_partkey as string)"
    return {
        "src_orders": f"""select o_orderkey as k, o_custkey as g from orders""",
        "sites": f"""select k, g, 'scaffold_' || cast(g % 10 as string) as CHROM, g * 1000 + 1 + (k * 37) % 997 as POS,
 {_BASE} || case when k % 7 = 3 then 'AT' when k % 9 = 4 then 'G' else '' end as REF,
 case when k % 7 = 3 then {_BASE} when k % 9 = 4 then {_OTHER} || 'C' else {_OTHER} end as ALT1,
 case when k % 5 = 0 then {_BASE} || 'TT' when k % 11 = 0 then '*' when k % 13 = 0 then {_THIRD} end as ALT2,
 cast(20 + k % 60 as double) + cast(k % 4 as double) / 4 as QUAL, 300 + k % 200 as DP,
 case when k % 501 = 7 then g * 1000 + 1 + (k * 37) % 997 + {LONG_SPAN} end as END_POS from src_orders""",
        "samples": """select cast(n_nationkey as int) as SAMPLE_POS, cast(n_nationkey + 101 as bigint) as SampleID,
 'ST.' || case when n_nationkey % 9 = 8 then 'X' when n_nationkey % 2 = 0 then 'F' else 'M' end || '.' || cast(n_nationkey as string) as GametophyteCode from nation""",
        "metadata": """select cast(c_custkey as bigint) as SampleID, 'ST.' || case when c_custkey % 9 = 8 then 'X' when c_custkey % 2 = 0 then 'F' else 'M' end
 || '.' || cast(c_custkey as string) as GametophyteCode, c_mktsegment as Site from customer""",
        "go": _union(
            [
                """select cast(p_partkey * 2 as bigint) as _row, 9000000 + p_partkey as proteinId, case p_partkey % 7 when 0 then 'Spo11 transesterase'
 when 1 then 'DNA mismatch repair MutS' when 2 then 'telomere maintenance' when 3 then cast(null as string) else p_name end as goName from part""",
                """select cast(p_partkey * 2 + 1 as bigint), 9000000 + p_partkey, case when p_partkey % 4 = 0 then p_brand || ';' || p_name else p_type end from part""",
            ]
        ),
        "ipr": """select cast(p_partkey as bigint) as _row, 9000000 + p_partkey as proteinId, case when p_partkey % 5 = 0 then 'double-strand break repair;' || p_type
 when p_partkey % 13 = 0 then cast(null as string) else p_type end as iprDesc from part""",
        "kegg": """select cast(c_custkey as bigint) as _row, 9000000 + c_custkey as proteinId, case when c_custkey % 12 = 5 then 'homologous recombination protein RecA'
 when c_custkey % 10 = 3 then cast(null as string) else c_mktsegment || ' kinase' end as definition from customer""",
        "kog": """select o_orderkey as _row, 9000000 + o_custkey as proteinId, case when o_orderkey % 9 = 4 then cast(null as string)
 when o_custkey % 50 = 9 then 'Meiosis-specific ' || o_orderpriority else o_orderpriority end as kogdefline from orders""",
        "curated": """select 9000000 + s_suppkey as protein, s_name as Note from supplier""",
        "vcf": f"""select k as ROW_ID, CHROM, POS, 'v' || cast(k as string) as ID, REF, {_per_alt("ALT1", "ALT2")} as ALT, QUAL, 'PASS' as FILTER,
 'AC=' || {_per_alt(_AC1, _AC2)} || ';AF=' || {_per_alt(_AF1, _AF2)} || ';AN=' || cast(20 + k % 5 as string) || ';DP=' || cast(DP as string)
 || case when k % 10 = 7 then ';DS' else '' end || coalesce(';END=' || cast(END_POS as string), '') || {_UNDECLARED} || ';MLEAC=' || {_per_alt(_AC1, _AC2)} || ';MLEAF=' || {_per_alt(_AF1, _AF2)} || ';MQ=60.25'
 || coalesce(';QD=' || {_QD}, '') || coalesce(';RAW_MQandDP=' || {_RAW}, '')
 || ';ANN=' || concat_ws(',', {", ".join(_entry_text(e) for _, _, e in entries)})
 || case when {_LOF[0][0]} then ';LOF=' || {_list_text(_LOF)} else '' end || case when {_NMD[0][0]} then ';NMD=' || {_list_text(_NMD)} else '' end as INFO,
 'GT:AD:DP:GQ:PL' as FORMAT, ALT2 from sites""",
        "gff": _union(
            [
                f"""select cast(p_partkey * 4 as bigint) as _row, {feature}, 'gene' as Type, {span}, '.' as Phase, 'ID=gene_' || {key} as Attributes from part""",
                f"""select cast(p_partkey * 4 + 1 as bigint), {feature}, 'mRNA', {span}, '.', 'ID=mRNA_' || {key} || ';Parent=gene_' || {key} || ';proteinId=' || cast(9000000 + p_partkey as string)
 || ';transcriptId=' || cast(7000000 + p_partkey as string) || case when p_partkey % 3 = 0 then ';product_name=' || p_name else '' end from part""",
                f"""select cast(p_partkey * 4 + 2 as bigint), {feature}, 'CDS', {span}, '0', 'ID=CDS_' || {key} || '_1;Parent=mRNA_' || {key} from part""",
                f"""select cast(p_partkey * 4 + 3 as bigint), {feature}, 'region', {span}, '.', 'ID=region' || {key}
 || case when p_partkey % 100 = 0 then ';proteinId=' || cast(8000000 + p_partkey as string) else '' end from part""",
            ]
        ),
        # The same facts as columns.
        "exp_alleles": _union(
            [
                f"""select k, g, CHROM, POS, REF, {alt} as ALT, {i} as ALT_IDX, QUAL, cast(DP as int) as DP, cast({ac} as int) as AC, cast({af} as double) as AF,
 cast({_QD} as double) as QD, cast(20 + k % 5 as int) as AN, {_RAW} as RAW_MQandDP, k % 10 = 7 as DS from sites where {alt} is not null"""
                for (i, alt), ac, af in zip(both, (_AC1, _AC2), (_AF1, _AF2))
            ]
        ),
        "exp_entries": _union(
            [
                f"""select k, {i} as ALT_IDX, {n} as ANN_N, {_place(entries, at)} as ANN_IDX, {e['alt']} as Allele, {e['effect']} as Effect, {e['impact']} as Impact,
 cast(9000000 + {e['gene']} as string) as Protein_ID, 'gene_' || cast({e['gene']} as string) as Gene_ID, {e['hgvs']} as HGVS_c,
 'p.' || cast(k % 50 as string) as HGVS_p, {e['dist']} as Dist_to_Feature, {e['debug']} as Debug from sites where {e['when']}"""
                for at, (i, n, e) in enumerate(entries)
            ]
        ),
        # Both alleles can be the same text; an entry describes the text.
        "exp_ann": """select a.k, a.CHROM, a.POS, a.REF, a.ALT, a.ALT_IDX, a.QUAL, a.DP, a.AC, a.AF, a.QD, a.AN, a.RAW_MQandDP, a.DS, e.ALT_IDX * 10 + e.ANN_N as ANN_N, e.ANN_IDX,
 e.Effect, e.Impact, e.Protein_ID, e.Gene_ID, e.HGVS_c, e.HGVS_p, e.Dist_to_Feature, e.Debug
 from exp_alleles a join exp_entries e on a.k = e.k and a.ALT = e.Allele""",
        "exp_lof": _union(
            [
                f"""select a.k, a.CHROM, a.POS, a.ALT, cast(9000000 + a.g as string) as Protein_ID, 'gene_' || cast(a.g as string) as Gene_ID,
 {n} as Total_Transcripts_LOF, cast('{p}' as double) as Percent_Transcripts_LOF from exp_alleles a where {w}"""
                for w, n, p in _LOF
            ]
        ),
        "exp_nmd": _union(
            [
                f"""select a.k, a.CHROM, a.POS, a.ALT, cast(9000000 + a.g as string) as Protein_ID, 'gene_' || cast(a.g as string) as Gene_ID,
 {n} as Total_Transcripts_NMD, cast('{p}' as double) as Percent_Transcripts_NMD from exp_alleles a where {w}"""
                for w, n, p in _NMD
            ]
        ),
        "exp_list_text": f"""select k, case when {_LOF[0][0]} then replace(replace(replace({_list_text(_LOF)}, '{LIST_PREFIX}', ''), '(', ''), ')', '') end as LOF,
 case when {_NMD[0][0]} then replace(replace(replace({_list_text(_NMD)}, '{LIST_PREFIX}', ''), '(', ''), ')', '') end as NMD from sites""",
    }


@cache
def views() -> dict[str, str]:
    """View name -> SQL, each using base tables and earlier views."""
    return _views()


def needed(select: str, texts: dict[str, str]) -> dict[str, str]:
    """The texts that ``select`` uses, directly or through others, in their order."""
    words = set(re.findall(r"\w+", select))
    for name in reversed(texts):
        if name in words:
            words |= set(re.findall(r"\w+", texts[name]))
    return {name: text for name, text in texts.items() if name in words}


def with_views(select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` behind the views it needs; ``extra`` are further views, on top of these."""
    texts = needed(select, views() | (extra or {}))
    if not texts:
        return select
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in texts.items()) + "\n" + select


def cell_sql(part: str) -> str:
    """SQL of one field of a sample cell, from the site columns and the SampleID ``s``."""
    return _CELL[part]


class Inputs:
    """The derived tables of one scale as DataFrames."""

    TABLES = ("orders", "part", "customer", "nation", "supplier")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self._sf_dir = sf_dir

    def _select(self, select: str, spread: bool = False) -> DataFrame:
        text = with_views(select)
        base = {t: self.table(t) for t in needed(text, dict.fromkeys(self.TABLES, ""))}
        if spread:
            base["orders"] = base["orders"].repartitionByRange(self.spark.sparkContext.defaultParallelism, "o_orderkey")
        heads = ",\n".join(f"{t} as (select * from {{{t}}})" for t in base)
        return self.spark.sql(f"with {heads},\n" + text.removeprefix("with "), **base)

    def table(self, name: str) -> DataFrame:
        """A base table."""
        return _read(self.spark, f"{self._sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        """A derived view as it is."""
        return self._select(f"select * from {name}")

    def raw_vcf(self) -> DataFrame:
        """VCF records with sample cells, computed from the orders."""
        fields = ", ".join(cell_sql(f) for f in ("GT", "AD", "DP", "GQ", "PL"))
        cells = f"transform(ids, s -> concat_ws(':', {fields}))"
        return self._select(
            f"select * except (k, ALT2, ids), {cells} as CELLS from"
            f" (select *, ROW_ID as k, sequence(101, 101 + {_LAST}) as ids from vcf)",
            spread=True,
        )

    def vcf(self) -> DataFrame:
        """VCF records, ingested to Parquet in the shared folder once per session and scale."""
        return self.stored("vcf", self.raw_vcf)

    def gff(self) -> DataFrame:
        """Feature rows, ingested once."""
        return self.stored("gff", self._raw_gff)

    def _raw_gff(self) -> DataFrame:
        return self.view("gff").withColumnsRenamed({"feature_start": "Start", "feature_end": "End"})

    def curated(self) -> DataFrame:
        """The curated gene list."""
        return self.view("curated").withColumnRenamed("protein", "Protein Id")

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored result of a stage, written to the shared folder at its first use."""
        key = (self.spark.sparkContext.applicationId, self._sf_dir, name)
        if key not in _STORED:
            path = new_path(self.spark, name)
            build().write.parquet(path)
            _STORED[key] = path
        return _read(self.spark, _STORED[key])

    def samples(self) -> DataFrame:
        """Sample metadata."""
        return self.view("samples").drop("SAMPLE_POS")

    def header_samples(self) -> DataFrame:
        """Samples at their place in the header."""
        return self.view("samples").drop("GametophyteCode")

    def annotation_tables(self) -> dict[str, DataFrame]:
        """The four gene-function tables."""
        return {source: self.view(source.lower()) for source in ("GO", "IPR", "KEGG", "KOG")}


_STORED: dict[tuple, str] = {}
_READ: dict[tuple, DataFrame] = {}


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; its files are listed once per session."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _READ:
        _READ[key] = spark.read.parquet(path)
    return _READ[key]
