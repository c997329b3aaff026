"""Cross prediction: calls of high-impact variants, ranked variants, crosses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.operators import calls, crosses, flatten, ranking
from varloom.operators.genes import annotate_variants
from varloom.operators.sites import sites_only, subset_sites
from varloom.params import Params
from varloom.plans.annotations import having, lof_and_nmd, parsed_records
from varloom.sources.store import bucketed


def _call_rows(records: DataFrame, lof: DataFrame, nmd: DataFrame, params: Params) -> DataFrame:
    parsed = calls.genotypes(parsed_records(records, params), params.mode)
    alleles = calls.allele_call_counts(flatten.decompose_alleles(parsed, params.info_schema, params.mode)).drop("GTS")
    ann = flatten.explode_ann(alleles, distinct=True, mode=params.mode)
    joined = flatten.join_counted_lof_nmd(ann, lof, nmd, params.lof_effects)
    return flatten.add_variant_type(flatten.blank_fields(joined))


def call_rows(records: DataFrame, params: Params) -> DataFrame:
    """One row per allele and distinct ANN entry, with call counts; the cells are still text."""
    raw = records.drop("ID", "FILTER")
    return _call_rows(raw, *lof_and_nmd(sites_only(raw), params), params)


def high_calls(records: DataFrame, params: Params) -> DataFrame:
    """High-impact rows of :func:`call_rows` with the summary of their site.

    The summary counts all rows of the site, so it is taken before the impact filter, from a few
    narrow columns. Only records with a high-impact entry carry their genotypes through a shuffle.
    """
    raw = records.drop("ID", "FILTER")
    lof, nmd = lof_and_nmd(sites_only(raw), params)
    summary = calls.site_allele_summary(
        _call_rows(raw, lof, nmd, params).select(
            "ROW_ID", "CHROM", "POS", "REF", "ALT", "ALT_IDX", "ANN_IDX", "N_ALT_GTS"
        )
    )
    high = _call_rows(having(raw, f"|{params.impact}|"), lof, nmd, params)
    return high.filter(F.col("Impact") == params.impact).join(summary, ["CHROM", "POS"])


#: What the tables of records at listed sites are bucketed by.
SITE = ("CHROM", "POS")


def store_subset(records: DataFrame, sites: DataFrame) -> DataFrame:
    """The records that cover a site of the list, stored once for all that follows, in buckets of their site.

    LOF and NMD joins, the site summary and the high-impact rows all take them from there, by site.
    """
    return bucketed(subset_sites(records, sites), "subset", SITE)


def calls_at(records: DataFrame, sites: DataFrame, params: Params) -> DataFrame:
    """:func:`high_calls` of the records that cover a site of the list; the others are left out first."""
    return high_calls(store_subset(records, sites), params)


def with_calls(variants: DataFrame) -> DataFrame:
    """Turn the cells into typed calls: ``CALLS``, one struct per sample."""
    return calls.ref_alt_depth(calls.parse_calls(variants, by_format="FORMAT" in variants.columns)).drop("FORMAT")


def split_calls(records: DataFrame, sites: DataFrame, params: Params) -> DataFrame:
    """The stored form of :func:`calls_at`, with typed calls."""
    return with_calls(calls_at(records, sites, params))


def rank_variants(variants: DataFrame, gene_table: DataFrame, params: Params, ordered: bool = True) -> DataFrame:
    """Variant rows with gene annotations and ranks; alleles with too few carriers are left out."""
    kept = calls.drop_singletons(variants, params.min_alt_genotypes)
    # Texts of genes take several times the size of their files, by which Spark would broadcast them.
    scored = ranking.effect_severity(annotate_variants(kept, gene_table.hint("merge")), params.severity)
    scored = ranking.term_rank(ranking.merge_annotations(scored), params.term_rank)
    ranked = ranking.combined_rank(scored)
    return ranking.rank_order(ranked) if ordered else ranked


def sample_calls(ranked: DataFrame, header_samples: DataFrame, samples: DataFrame) -> DataFrame:
    """One row per ranked variant row and sample, with the sample's code and sex.

    Takes variants with their cells or with typed calls. Cells are split after they are exploded.
    """
    typed = "CALLS" in ranked.columns
    by_format = "FORMAT" in ranked.columns
    rows = calls.calls_long(ranked, header_samples) if typed else calls.cells_long(ranked, header_samples, by_format)
    return crosses.calls_with_sample(rows.drop("AD", "PL", "FORMAT"), samples)


def good_calls(ranked: DataFrame, header_samples: DataFrame, samples: DataFrame, params: Params) -> DataFrame:
    """Sample calls that pass the filters."""
    return calls.filter_calls(
        sample_calls(ranked, header_samples, samples),
        samples.agg(F.count("*")).scalar(),
        params.max_af,
        params.min_call_rate,
        params.min_depth,
        params.min_quality,
    )


def kept_samples(ranked: DataFrame, header_samples: DataFrame, samples: DataFrame, params: Params) -> DataFrame:
    """The best calls per allele and sex, of alleles that both sexes carry.

    Taking the best calls leaves every sex of an allele in place, so the two steps give the same
    rows in either order; this way the second one sees a few rows per allele.
    """
    good = good_calls(ranked, header_samples, samples, params)
    best = crosses.top_samples(good, params.samples_per_sex, params.per_sample)
    return crosses.both_sexes(best, params.strict_sexes, few_calls=True)


def cross_table(ranked: DataFrame, header_samples: DataFrame, samples: DataFrame, params: Params) -> DataFrame:
    """One row per variant row and cross, with ``Cross_Order`` for sorting."""
    return crosses.expand_crosses(kept_samples(ranked, header_samples, samples, params))


def cross_list(ranked: DataFrame, header_samples: DataFrame, samples: DataFrame, params: Params) -> DataFrame:
    """The ranked list of crosses."""
    return crosses.cross_list(cross_table(ranked, header_samples, samples, params))


def best_crosses(
    ranked: DataFrame, header_samples: DataFrame, samples: DataFrame, params: Params, n: int = 100
) -> DataFrame:
    """The first ``n`` crosses of :func:`cross_list`."""
    return crosses.best_crosses(kept_samples(ranked, header_samples, samples, params), n)
