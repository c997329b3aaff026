"""Field layouts, dictionaries and thresholds.

Everything that a study may want to change sits in :class:`Params`; the module constants are its
defaults. There is no default ID prefix.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------------------------
# Field layouts of the input formats.
# --------------------------------------------------------------------------------------------

VCF_FIXED = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"]

# INFO key -> (Spark type, number). "A" means one value per ALT allele.
INFO_SCHEMA: dict[str, tuple[str, str]] = {
    "AC": ("int", "A"),
    "AF": ("double", "A"),
    "AN": ("int", "1"),
    "BaseQRankSum": ("double", "1"),
    "DP": ("int", "1"),
    "DS": ("boolean", "0"),
    "END": ("int", "1"),
    "ExcessHet": ("double", "1"),
    "FS": ("double", "1"),
    "InbreedingCoeff": ("double", "1"),
    "MLEAC": ("int", "A"),
    "MLEAF": ("double", "A"),
    "MQ": ("double", "1"),
    "MQRankSum": ("double", "1"),
    "QD": ("double", "1"),
    "RAW_MQandDP": ("string", "2"),
    "ReadPosRankSum": ("double", "1"),
    "SOR": ("double", "1"),
    "ANN": ("string", "."),
    "LOF": ("string", "."),
    "NMD": ("string", "."),
}

# The 16 fields of one ANN entry, in order: column here -> column name in reports.
ANN_FIELDS: dict[str, str] = {
    "Allele": "Allele",
    "Effect": "Effect",
    "Impact": "Impact",
    "Protein_ID": "Protein_ID",
    "Gene_ID": "Gene_ID",
    "Feature_Type": "Feature_Type",
    "Feature_ID": "Feature_ID",
    "Transcript_BioType": "Transcript_BioType",
    "Exon_Intron_Rank": "Exon_or_Intron_Rank/Total",
    "HGVS_c": "HGVS.c",
    "HGVS_p": "HGVS.p",
    "cDNA_Position": "cDNA_position/cDNA_len",
    "CDS_Position": "CDS_position/CDS_len",
    "Protein_Position": "Protein_position/Protein_len",
    "Dist_to_Feature": "Dist_to_Feature",
    "Debug": "Debug",
}

LOF_FIELDS = ["Protein_ID", "Gene_ID", "Total_Transcripts_LOF", "Percent_Transcripts_LOF"]
NMD_FIELDS = ["Protein_ID", "Gene_ID", "Total_Transcripts_NMD", "Percent_Transcripts_NMD"]

# FORMAT fields, in order: column here -> FORMAT key.
CALL_FIELDS: dict[str, str] = {"GT": "GT", "AD": "AD", "DP_S": "DP", "GQ": "GQ", "PL": "PL"}


# Annotation table -> name column.
NAME_COLUMNS = {"GO": "goName", "IPR": "iprDesc", "KEGG": "definition", "KOG": "kogdefline"}

# --------------------------------------------------------------------------------------------
# Dictionaries.
# --------------------------------------------------------------------------------------------

# Effects that make a loss-of-function or nonsense-mediated-decay record count.
LOF_EFFECTS = [
    "frameshift_variant",
    "stop_gained",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "start_lost",
]

# Terms searched in the annotation tables to find proteins of interest.
SEARCH_TERMS = [
    "Spo11",
    "Mre11",
    "Rad50",
    "Rad51",
    "RecA",
    "DMC1",
    "Red1",
    "Hop1",
    "Smc5",
    "MutS",
    "meio",
    "reproduct",
    "double-strand break",
    " homologous recomb",
]

# Terms that rank a variant by its gene's function; 1 is the most relevant.
TERM_RANK: dict[str, int] = {
    "Spo11": 1,
    "Mre11": 1,
    "Rad50": 1,
    "RecA": 1,
    "DMC1": 1,
    "Red1": 1,
    "Hop1": 1,
    "Smc5": 1,
    "Exo1": 1,
    "meio": 2,
    "reproduct": 2,
    "MutS": 2,
    "double-strand break": 3,
    " homologous recomb": 3,
    "SCC": 4,
    "recombination": 4,
    "crossover": 4,
    "telomere": 4,
}

# Effect severity; 1 is the most severe.
EFFECT_SEVERITY: dict[str, int] = {
    "stop_gained": 1,
    "frameshift_variant": 2,
    "stop_lost": 3,
    "start_lost": 4,
    "splice_acceptor_variant": 5,
    "splice_donor_variant": 6,
    "exon_loss_variant": 7,
    "splice_region_variant": 8,
    "conservative_inframe_deletion": 9,
    "conservative_inframe_insertion": 10,
    "5_prime_UTR_variant": 11,
    "3_prime_UTR_variant": 12,
    "intron_variant": 13,
}

# --------------------------------------------------------------------------------------------


# What to do with entries of a wrong field count.
MODES = ("failfast", "permissive")


@dataclass(frozen=True)
class Params:
    """Study settings.

    ``ann_prefix`` is removed from ANN and ``list_prefix`` from LOF and NMD, both as plain text.
    ``product_overrides`` maps protein IDs to text added to their product. ``mode`` says what an entry or
    cell of a wrong field count or a per-allele list of a wrong length does: end the job, or be left out and
    reported by ``bad_records``. ``info_rest`` names the column of INFO keys outside the schema; None drops them.
    """

    ann_prefix: str | None = None
    list_prefix: str | None = None
    info_schema: dict[str, tuple[str, str]] = field(default_factory=lambda: dict(INFO_SCHEMA))
    lof_effects: tuple[str, ...] = tuple(LOF_EFFECTS)
    search_terms: tuple[str, ...] = tuple(SEARCH_TERMS)
    term_rank: dict[str, int] = field(default_factory=lambda: dict(TERM_RANK))
    severity: dict[str, int] = field(default_factory=lambda: dict(EFFECT_SEVERITY))
    product_overrides: dict[str, str] = field(default_factory=dict)
    impact: str = "HIGH"
    min_alt_genotypes: int = 2
    max_af: float = 0.15
    min_call_rate: float = 0.8
    min_depth: int = 10
    min_quality: int = 20
    samples_per_sex: int = 2
    strict_sexes: bool = True
    per_sample: bool = False
    mode: str = "failfast"
    info_rest: str | None = "INFO_REST"

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode is one of {', '.join(MODES)}, not {self.mode}")
