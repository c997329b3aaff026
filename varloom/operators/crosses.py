"""From ranked variants and calls to crosses between carriers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.functions.text import sex_from_code
from varloom.operators.order import with_rank
from varloom.session import new_path

VARIANT = ["CHROM", "POS", "REF", "ALT"]

# What tells variant rows of one allele apart. All may be NULL except the first three.
ROW_KEYS = [
    "ROW_ID",
    "ALT_IDX",
    "ANN_IDX",
    "Total_Transcripts_LOF",
    "Percent_Transcripts_LOF",
    "Total_Transcripts_NMD",
    "Percent_Transcripts_NMD",
    "ID",
]
SAMPLE_COLUMNS = [
    "SAMPLE_POS",
    "SampleID",
    "GametophyteCode",
    "Sex",
    "GT",
    "DP_S",
    "GQ",
    "AD_REF",
    "AD_ALT",
    "PL_REF",
    "PL_ALT",
]


def sample_index(metadata: DataFrame) -> DataFrame:
    """Distinct samples with the sex read from their code, by SampleID."""
    samples = metadata.select("SampleID", "GametophyteCode").distinct()
    return samples.withColumn("Sex", sex_from_code(F.col("GametophyteCode"))).orderBy("SampleID")


def sample_id_check(samples: DataFrame, vcf_ids: DataFrame) -> DataFrame:
    """IDs that only one side has; none when metadata and VCF agree."""
    left = samples.select(F.col("SampleID").alias("sample")).distinct()
    right = vcf_ids.select(F.col("SampleID").alias("vcf")).distinct()
    both = left.join(right, F.col("sample") == F.col("vcf"), "full")
    odd = both.filter(F.col("sample").isNull() | F.col("vcf").isNull())
    side = F.when(F.col("vcf").isNull(), "metadata").otherwise("vcf")
    return odd.select(F.coalesce("sample", "vcf").alias("SampleID"), side.alias("Found_In"))


def calls_with_sample(calls: DataFrame, samples: DataFrame) -> DataFrame:
    """Left join of the sample index; two index rows for one sample end the job."""
    columns = [c for c in samples.columns if c != "SampleID"]
    unique = samples.groupBy("SampleID").agg(
        F.count("*").alias("_n"), F.max(F.struct(*columns)).alias("_sample")
    )
    message = F.concat(F.lit("more than one index row for sample "), F.col("SampleID").cast("string"))
    # The check sits inside the value, so that no projection can drop it.
    checked = F.when(F.col("_n") == 1, F.col("_sample")).otherwise(F.raise_error(message))
    rows = unique.select("SampleID", checked.alias("_sample"))
    return calls.join(rows, "SampleID", "left").select(*calls.columns, *[f"_sample.{c}" for c in columns])


def both_sexes(calls: DataFrame, strict: bool = True, few_calls: bool = False) -> DataFrame:
    """Calls of alleles that both sexes carry.

    ``strict`` asks for exactly two different values of Sex and counts a missing one as a value;
    without it a female and a male are enough. The values combine before the shuffle, and the
    join back can split a hot allele. ``few_calls`` says that each allele has a bounded number of
    calls, as after :func:`top_samples`; a window then spares reading the input twice.
    """
    if strict:
        keep = [F.collect_set(F.coalesce("Sex", F.lit("?")))]
        test = F.size("_sexes0") == 2
    else:
        keep = [F.max(F.col("Sex") == "F"), F.max(F.col("Sex") == "M")]
        test = F.col("_sexes0") & F.col("_sexes1")
    named = {f"_sexes{i}": value for i, value in enumerate(keep)}
    if few_calls:
        allele = Window.partitionBy(*VARIANT)
        return calls.withColumns({n: v.over(allele) for n, v in named.items()}).filter(test).drop(*named)
    alleles = calls.groupBy(*VARIANT).agg(*[v.alias(n) for n, v in named.items()]).filter(test)
    return calls.join(alleles, VARIANT, "left_semi")


def _best_first() -> list[Column]:
    """Order of calls: by variant rank, then by quality, then by place in the file."""
    return [
        F.col("Comb_Rank").asc_nulls_last(),
        F.col("N_ALT_GTS").asc_nulls_last(),
        F.col("AF").asc_nulls_last(),
        F.col("GQ").desc_nulls_last(),
        F.col("DP_S").desc_nulls_last(),
        F.col("AD_ALT").desc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in ("N_ALT_ALLELES", *ROW_KEYS, "SAMPLE_POS")],
    ]


def top_samples(calls: DataFrame, k: int = 2, per_sample: bool = False) -> DataFrame:
    """The ``k`` best calls of each sex for each allele.

    A sample may fill several places through different annotation rows; ``per_sample`` lets it
    fill one only.
    """
    rows = calls
    if per_sample:
        own = Window.partitionBy(*VARIANT, "Sex", "SampleID").orderBy(*_best_first())
        rows = rows.withColumn("_own", F.row_number().over(own)).filter("_own <= 1").drop("_own")
    place = Window.partitionBy(*VARIANT, "Sex").orderBy(*_best_first())
    return rows.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= k).drop("_place")


def _order_key() -> Column:
    """The order of the kept calls as one value that ``min`` and sorting compare.

    NULL would come first in a struct, so missing values become the largest.
    """
    last = F.lit(float("inf"))

    def up(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), last).alias(c)

    def down(c: str) -> Column:
        return F.coalesce(-F.col(c).cast("double"), last).alias(c)

    sex = F.coalesce("Sex", F.lit("~")).alias("Sex")
    return F.struct(
        up("Comb_Rank"),
        up("N_ALT_GTS"),
        up("AF"),
        down("GQ"),
        down("DP_S"),
        down("AD_ALT"),
        *VARIANT,
        sex,
        up("N_ALT_ALLELES"),
        *[F.coalesce(F.col(c).cast("bigint"), F.lit(1 << 62)).alias(c) for c in ("ROW_ID", "ALT_IDX", "ANN_IDX")],
        *[up(c) for c in ROW_KEYS if c.endswith(("_LOF", "_NMD"))],
        F.coalesce("ID", F.lit("~")).alias("ID"),
        F.col("SAMPLE_POS"),
    )


def _variant_rows(calls: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """One row per variant row: its best call and the codes of its females and males, best first."""
    variant_columns = [c for c in calls.columns if c not in SAMPLE_COLUMNS]
    others = [c for c in variant_columns if c not in (*VARIANT, *ROW_KEYS)]
    keyed = calls.withColumn("_key", _order_key())

    def side(sex: str) -> Column:
        entry = F.struct(F.col("_key"), F.col("GametophyteCode").alias("code"))
        return F.array_sort(F.collect_list(F.when(F.col("Sex") == sex, entry)))["code"]

    keys = [k for k in ROW_KEYS if k in calls.columns]
    rows = keyed.groupBy(*VARIANT, *keys).agg(
        F.first(F.struct(*others)).alias("_others"),
        F.min("_key").alias("_best"),
        side("F").alias("_females"),
        side("M").alias("_males"),
    )
    return rows, variant_columns, others


def _expanded(rows: DataFrame) -> DataFrame:
    """Every female with every male of a row."""
    rows = rows.select("*", F.posexplode("_males").alias("_m", "M_ID"))
    return rows.select("*", F.posexplode("_females").alias("_f", "F_ID"))


def expand_crosses(calls: DataFrame) -> DataFrame:
    """Every female with every male of one variant row, in rank order.

    Takes the calls :func:`top_samples` kept, so a variant row holds a few calls only. Adds
    ``F_ID``, ``M_ID``, ``Cross`` and ``Cross_Order``, the place of the cross: variant rows by
    their best call, then the males, and the females fastest.
    """
    rows, variant_columns, others = _variant_rows(calls)
    return _expanded(rows).select(
        "F_ID",
        "M_ID",
        F.concat_ws(" x ", "F_ID", "M_ID").alias("Cross"),
        *[F.col(f"_others.{c}") if c in others else F.col(c) for c in variant_columns],
        F.struct("_best", "_m", "_f").alias("Cross_Order"),
    )


def cross_list(crosses: DataFrame) -> DataFrame:
    """Each cross once, numbered in order of first appearance: Rank, Cross, F_ID, M_ID."""
    firsts = crosses.groupBy("Cross", "F_ID", "M_ID").agg(F.min("Cross_Order").alias("_order"))
    return with_rank(firsts, [F.col("_order")]).select("Rank", "Cross", "F_ID", "M_ID")


def best_crosses(calls: DataFrame, n: int, rows_seen: list[int] | None = None) -> DataFrame:
    """The first ``n`` rows of :func:`cross_list`, without expanding or ranking all crosses.

    Crosses are numbered by the best variant row they appear in. So once the best rows give ``n`` crosses,
    no later row can add one before them: rows are taken in growing numbers, best first, until they
    do. Each round keeps a bounded number of rows. ``rows_seen`` gets how many variant rows each round
    expanded.
    """
    spark = calls.sparkSession
    rows, _, _ = _variant_rows(calls)
    slim = rows.select("_best", "_females", "_males")
    paired = slim.filter((F.size("_females") > 0) & (F.size("_males") > 0))
    path = new_path(spark, "variant-rows")
    paired.write.parquet(path)
    stored = spark.read.parquet(path)
    taken = n
    while True:
        head = _expanded(stored.orderBy("_best").limit(taken))
        firsts = head.groupBy(F.concat_ws(" x ", "F_ID", "M_ID").alias("Cross"), "F_ID", "M_ID").agg(F.min(F.struct("_best", "_m", "_f")).alias("_order"))
        best = firsts.orderBy("_order").limit(n)
        kept = new_path(spark, "best-crosses")
        best.write.parquet(kept)
        found = spark.read.parquet(kept)
        if rows_seen is not None:
            rows_seen.append(taken)
        if found.count() >= n or taken >= stored.count():
            break
        taken *= 4
    # At most n rows, the report asked for.
    rank = F.row_number().over(Window.orderBy("_order")).cast("bigint").alias("Rank")
    return found.select(rank, "Cross", "F_ID", "M_ID")
