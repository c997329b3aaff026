"""DuckDB SQL for the registered queries.

Every text starts from the same derived views as the inputs. Where the engine parses VCF text,
the SQL starts from the ``exp_*`` views instead, which state the same facts as columns.
"""

from __future__ import annotations

from varloom.fixtures import ANN_PREFIX, LIST_PREFIX, cell_sql, with_views
from varloom.params import EFFECT_SEVERITY, LOF_EFFECTS, SEARCH_TERMS, TERM_RANK

_TERMS = "(?i)" + "|".join(SEARCH_TERMS)
_COUNTS = "regexp_matches(Effect, '" + "|".join(LOF_EFFECTS) + "')"
_VARIANT_TYPE = "case when ALT = '*' or length(REF) <> length(ALT) then 'INDEL' else 'SNP' end"


def _cast(name: str, kind: str) -> str:
    return f"try_cast(case when {name} not like '%.%' then {name} end as {kind})"


def _least(dictionary: dict[str, int], test: str) -> str:
    return "least(" + ", ".join(f"case when {test.format(t)} then {r} end" for t, r in dictionary.items()) + ")"


_EFFECT_RANK = "coalesce(" + _least(EFFECT_SEVERITY, "list_contains(string_split(Effect, '&'), '{}')") + ", 'inf'::double)::double"
_HAS_TERM = "contains(lower(Annotations), lower('{}'))"
_ANNOT_RANK = f"cast(coalesce({_least(TERM_RANK, _HAS_TERM)}, {max(TERM_RANK.values()) + 1}) as int)"
_MATCHED = "nullif(concat_ws(', ', " + ", ".join(f"case when {_HAS_TERM.format(t)} then '{t}' end" for t in TERM_RANK) + "), '')"


def _merged(columns: list[str]) -> str:
    parts = "flatten([" + ", ".join(f"coalesce(string_split({c}, ';'), [])" for c in columns) + "])"
    return f"(select array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ';') from (select {parts} as l))"


_MERGED = _merged(["IPR", "KEGG", "GO", "KOG", "Protein_Product"])


def _klass(ref: str, alt: str) -> str:
    """Class of one allele by comparing what is left after the shared ends are taken off."""
    head = f"coalesce(list_max(list_filter(range(0, least(length({ref}), length({alt})) + 1), lambda n: left({ref}, n) = left({alt}, n))), 0)"
    tail = f"coalesce(list_max(list_filter(range(0, least(length({ref}), length({alt})) + 1), lambda n: right({ref}, n) = right({alt}, n))), 0)"
    return f"""case when {alt} = '*' then 'overlap' when {alt} is null or {ref} = {alt} then 'ref'
 when length({ref}) = length({alt}) then case when {head} + {tail} = length({ref}) - 1 then 'snp' else 'mnp' end
 when {head} + {tail} >= least(length({ref}), length({alt})) then 'indel' else 'other' end"""


_GATED = """, nullif(HGVS_c, '') as HGVS_c, HGVS_p, nullif(Dist_to_Feature, '') as Dist_to_Feature"""

_REST = """case when k % 12 = 4 then '{"LENG":"' || cast(k % 7 as varchar) || '"' || case when k % 24 = 4 then ',"NOVEL":true' else '' end || '}' end"""

# Later views, in order; a query gets those it needs by getting all of them.
_MORE = {
    "ann": "select * from exp_ann",
    "dlof": "select distinct CHROM, POS, ALT, Gene_ID, Protein_ID, Total_Transcripts_LOF, Percent_Transcripts_LOF from exp_lof",
    "dnmd": "select distinct CHROM, POS, ALT, Gene_ID, Protein_ID, Total_Transcripts_NMD, Percent_Transcripts_NMD from exp_nmd",
    "ann_lost": f"""select a.*, l.Total_Transcripts_LOF, l.Percent_Transcripts_LOF, n.Total_Transcripts_NMD, n.Percent_Transcripts_NMD,
 l.Total_Transcripts_LOF is not null as isLOF, n.Total_Transcripts_NMD is not null as isNMD,
 case when l.Total_Transcripts_LOF is not null then t.LOF end as LOF, case when n.Total_Transcripts_NMD is not null then t.NMD end as NMD
 from (select *, {_COUNTS} as counts from ann) a
 left join dlof l on a.counts and a.CHROM = l.CHROM and a.POS = l.POS and a.ALT = l.ALT and a.Gene_ID = l.Gene_ID and a.Protein_ID = l.Protein_ID
 left join dnmd n on a.counts and a.CHROM = n.CHROM and a.POS = n.POS and a.ALT = n.ALT and a.Gene_ID = n.Gene_ID and a.Protein_ID = n.Protein_ID
 join exp_list_text t on a.k = t.k""",
    "split_ann": f"""select distinct CHROM, POS, REF, ALT, {_VARIANT_TYPE} as Variant_Type, QUAL, AC, AF, AN, DP, DS, QD, RAW_MQandDP,
 Effect, Impact, Protein_ID, Gene_ID{_GATED}, LOF, Total_Transcripts_LOF, Percent_Transcripts_LOF, NMD, Total_Transcripts_NMD,
 Percent_Transcripts_NMD, isLOF, isNMD, {_REST} as INFO_REST from ann_lost""",
    "split_eff": "select * replace (unnest(string_split(Effect, '&')) as Effect) from split_ann",
    "messages": """select a.CHROM, a.POS, a.REF, a.ALT, a.Effect, a.Protein_ID, a.Debug from ann a
 left join exp_lof l on a.CHROM = l.CHROM and a.POS = l.POS and a.ALT = l.ALT and a.Gene_ID = l.Gene_ID and a.Protein_ID = l.Protein_ID
 left join exp_nmd n on a.CHROM = n.CHROM and a.POS = n.POS and a.ALT = n.ALT and a.Gene_ID = n.Gene_ID and a.Protein_ID = n.Protein_ID""",
    "cells0": f"""select k, ALT2, s - 101 as place, s as SampleID, {cell_sql('GT')} as gt, {cell_sql('AD')} as ad, {cell_sql('DP')} as dp,
 {cell_sql('GQ')} as gq, {cell_sql('PL')} as pl from (select k, ALT2, unnest(range(101, 102 + (select max(n_nationkey) from nation))) as s from sites)""",
    "cells": f"""select k, cast(place as int) as place, cast(SampleID as bigint) as SampleID, {_cast('gt', 'int')} as GT, ad as AD, {_cast('dp', 'int')} as DP_S,
 {_cast('gq', 'int')} as GQ, case when pl not like '%.%' then pl end as PL from cells0""",
    "calls": """select *, case when GT is not null then try_cast(string_split(AD, ',')[1] as int) end as AD_REF,
 case when GT <> 0 then try_cast(string_split(AD, ',')[GT + 1] as int) end as AD_ALT,
 case when GT is not null then try_cast(string_split(PL, ',')[1] as int) end as PL_REF,
 case when GT <> 0 then try_cast(string_split(PL, ',')[GT + 1] as int) end as PL_ALT from cells""",
    "call_counts": """select a.k, a.CHROM, a.POS, a.REF, a.ALT, a.ALT_IDX, cast(count(*) filter (c.GT = a.ALT_IDX) as int) as N_ALT_GTS,
 cast(count(c.GT) as int) as N_CALLS from exp_alleles a join cells c on a.k = c.k group by all""",
    "call_rows": """select x.* exclude (Debug, ANN_N, ANN_IDX), min(x.ANN_N) as ANN_N, c.N_ALT_GTS, c.N_CALLS from ann_lost x
 join call_counts c on x.k = c.k and x.ALT_IDX = c.ALT_IDX group by all""",
    "site_summary": """select CHROM, POS, cast(count(*) as int) as N_ALT_ALLELES, cast(count(distinct (REF, ALT)) as int) as N_ALT_DISTINCT,
 string_agg(N_ALT_GTS || ':' || REF || '>' || ALT, ', ' order by k, ALT_IDX, ANN_N) as ALT_SUMMARY from call_rows group by CHROM, POS""",
    "gff_wide": """select _row, CHROM, Type, feature_start, feature_end, Strand, Phase, nullif(regexp_extract(Attributes, '(?:^|;)ID=([^;]*)', 1), '') as ID,
 nullif(regexp_extract(Attributes, 'proteinId=([^;]*)', 1), '') as Protein_ID, nullif(regexp_extract(Attributes, 'transcriptId=([^;]*)', 1), '') as Transcript_ID,
 coalesce(nullif(regexp_extract(Attributes, 'Parent=([^;]*)', 1), ''), nullif(regexp_extract(Attributes, '(?:^|;)ID=([^;]*)', 1), '')) as Parent,
 nullif(regexp_extract(Attributes, 'product_name=([^;]*)', 1), '') as Protein_Product from gff""",
    "gff_gene": "select *, 'gene_' || coalesce(string_split(Parent, '_')[2], 'NA') as Gene_ID from gff_wide",
    "features": "select _row, CHROM, Type, feature_start, feature_end, Strand, Phase, ID, Parent, Gene_ID, "
    + ", ".join(
        f"""coalesce(last_value({c} ignore nulls) over (partition by Gene_ID order by _row rows between unbounded preceding and current row),
 first_value({c} ignore nulls) over (partition by Gene_ID order by _row rows between current row and unbounded following)) as {c}"""
        for c in ("Protein_ID", "Transcript_ID", "Protein_Product")
    )
    + " from gff_gene",
    "names": """select 'GO' as source, _row, proteinId::varchar as Protein_ID, coalesce(goName, 'NA') as name from go
 union all select 'IPR', _row, proteinId::varchar, iprDesc from ipr union all select 'KEGG', _row, proteinId::varchar, definition from kegg
 union all select 'KOG', _row, proteinId::varchar, kogdefline from kog""",
    "collapsed": "select source, Protein_ID, coalesce(string_agg(name, ';' order by _row), '') as names from names group by source, Protein_ID",
    "found": f"select distinct source, Protein_ID from collapsed where regexp_matches(names, '{_TERMS}')",
    "wanted": "select Protein_ID from found union select protein::varchar from curated",
    "proteins": """select Protein_ID, GO, IPR, KEGG, KOG from (select Protein_ID, names as GO from collapsed where source = 'GO')
 full join (select Protein_ID, names as IPR from collapsed where source = 'IPR') using (Protein_ID)
 full join (select Protein_ID, names as KEGG from collapsed where source = 'KEGG') using (Protein_ID)
 full join (select Protein_ID, names as KOG from collapsed where source = 'KOG') using (Protein_ID)""",
    "genes": """select Protein_ID, GO, IPR, KEGG, KOG, CHROM, Type, feature_start, feature_end, Strand, Phase, ID, Transcript_ID, Parent, Gene_ID,
 case when Protein_ID = '9000007' then coalesce(Protein_Product, 'NA') || ';patched product (Exo1)' else Protein_Product end as Protein_Product
 from proteins join features using (Protein_ID) where Type <> 'mRNA' and Protein_ID in (select Protein_ID from wanted)""",
    "gene_rows": """select * replace (nullif(nullif(GO, ''), 'NA') as GO, nullif(nullif(IPR, ''), 'NA') as IPR, nullif(nullif(KEGG, ''), 'NA') as KEGG,
 nullif(nullif(KOG, ''), 'NA') as KOG, nullif(nullif(Protein_Product, ''), 'NA') as Protein_Product) from genes where Type = 'gene'""",
    "listed": """select distinct a.CHROM, a.POS from ann a join genes g on a.CHROM = g.CHROM and a.Protein_ID = g.Protein_ID and a.Gene_ID = g.Gene_ID
 where a.Impact = 'HIGH' and a.POS between g.feature_start and g.feature_end""",
    "covered": """select distinct s.k from sites s join listed l on l.CHROM = s.CHROM and l.POS between s.POS and greatest(s.POS + length(s.REF) - 1, s.END_POS)""",
    "covered_rows": "select * from call_rows where k in (select k from covered)",
    "covered_summary": """select CHROM, POS, cast(count(*) as int) as N_ALT_ALLELES, cast(count(distinct (REF, ALT)) as int) as N_ALT_DISTINCT,
 string_agg(N_ALT_GTS || ':' || REF || '>' || ALT, ', ' order by k, ALT_IDX, ANN_N) as ALT_SUMMARY from covered_rows group by CHROM, POS""",
    "high_calls": """select r.*, s.N_ALT_ALLELES, s.N_ALT_DISTINCT, s.ALT_SUMMARY from covered_rows r join covered_summary s on r.CHROM = s.CHROM and r.POS = s.POS
 where Impact = 'HIGH'""",
    "ranked0": f"""select v.*, g.GO, g.IPR, g.KEGG, g.KOG, g.Protein_Product, g.ID from high_calls v left join gene_rows g
 on v.CHROM = g.CHROM and v.Protein_ID = g.Protein_ID and v.Gene_ID = g.Gene_ID where v.N_ALT_GTS > 1""",
    "ranked1": f"select *, {_EFFECT_RANK} as Effect_Rank, {_MERGED} as Annotations from ranked0",
    "ranked": f"select *, {_MATCHED} as Matched_Terms, {_ANNOT_RANK} as Annot_Rank, Effect_Rank + {_ANNOT_RANK} as Comb_Rank from ranked1",
    "index0": "select SAMPLE_POS, SampleID, GametophyteCode, nullif(regexp_extract(GametophyteCode, '\\.([MF])\\.', 1), '') as Sex from samples",
    "sampled": """select r.* exclude (ID), coalesce(r.ID, '~') as ID, c.place, c.SampleID, c.GT, c.DP_S, c.GQ, c.AD_REF, c.AD_ALT, c.PL_REF, c.PL_ALT, i.GametophyteCode, i.Sex
 from ranked r join calls c on r.k = c.k left join index0 i on c.SampleID = i.SampleID""",
    "good": """select * from sampled where GT = ALT_IDX and AF <= 0.15 and N_CALLS / (select count(*) from samples) >= 0.8 and DP_S >= 10 and GQ >= 20""",
    "paired": """select * from good semi join (select CHROM, POS, REF, ALT from good group by all having count(distinct coalesce(Sex, '?')) = 2) using (CHROM, POS, REF, ALT)""",
}
_TIE = """N_ALT_ALLELES, k, ALT_IDX, ANN_N, Total_Transcripts_LOF nulls last, Percent_Transcripts_LOF nulls last,
 Total_Transcripts_NMD nulls last, Percent_Transcripts_NMD nulls last, ID, place"""
_BEST = "Comb_Rank nulls last, N_ALT_GTS, AF, GQ desc, DP_S desc, AD_ALT desc nulls last"
_MORE |= {
    "kept": f"""select * from (select *, row_number() over (partition by CHROM, POS, REF, ALT, Sex order by {_BEST}, {_TIE}) as nth from paired) where nth <= 2""",
    "placed": f"select *, row_number() over (order by {_BEST}, CHROM, POS, REF, ALT, Sex nulls last, {_TIE}) as placed_at from kept",
    "grouped": """select *, min(placed_at) over (partition by k, ALT_IDX, ANN_N, Total_Transcripts_LOF, Percent_Transcripts_LOF, Total_Transcripts_NMD,
 Percent_Transcripts_NMD, ID) as gpos from placed""",
    "crossed": """select f.* exclude (placed_at, GametophyteCode), f.GametophyteCode as F_ID, m.GametophyteCode as M_ID,
 f.GametophyteCode || ' x ' || m.GametophyteCode as "Cross", m.placed_at as mpos, f.placed_at as fpos from grouped f join grouped m on f.gpos = m.gpos and f.Sex = 'F' and m.Sex = 'M'""",
}

_ALLELE = "CHROM, POS, REF, ALT"
_ENTRY = "Effect, Impact, Protein_ID, Gene_ID, HGVS_c, HGVS_p, Dist_to_Feature"
_LOSS = "Total_Transcripts_LOF, Percent_Transcripts_LOF, Total_Transcripts_NMD, Percent_Transcripts_NMD"
_CALL = "SampleID, GT, DP_S, GQ, AD_REF, AD_ALT, PL_REF, PL_ALT"
_KEPT = f"k as ROW_ID, {_ALLELE}, ALT_IDX, Effect, Gene_ID, Comb_Rank, AF, N_ALT_GTS, GametophyteCode, Sex, {_CALL}"
_ALL_LOST = f"""select a.*, l.Total_Transcripts_LOF, l.Percent_Transcripts_LOF, n.Total_Transcripts_NMD, n.Percent_Transcripts_NMD from ann a
 left join exp_lof l on a.CHROM = l.CHROM and a.POS = l.POS and a.ALT = l.ALT and a.Gene_ID = l.Gene_ID and a.Protein_ID = l.Protein_ID
 left join exp_nmd n on a.CHROM = n.CHROM and a.POS = n.POS and a.ALT = n.ALT and a.Gene_ID = n.Gene_ID and a.Protein_ID = n.Protein_ID"""
_CLASSES = f"select *, {_klass('REF', 'ALT1')} as c1, case when ALT2 is not null then {_klass('REF', 'ALT2')} end as c2 from sites"


def _has(kind: str) -> str:
    return f"(c1 = '{kind}' or coalesce(c2 = '{kind}', false))"


def _box(source: str, by: str) -> str:
    metrics = ["AF", "QUAL", "DP", "QD", "AC"]
    long = " union all ".join(f"select {by}, '{m}' as Metric, {m}::double as v from {source} where {m} is not null" for m in metrics)
    return f"""select b.{by}, b.Metric, b.n, round(q1, 6) as q1, round(med, 6) as med, round(q3, 6) as q3,
 round(least(q1, min(v)), 6) as lo, round(greatest(q3, max(v)), 6) as hi
 from (select {by}, Metric, count(*) as n, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as med, quantile_cont(v, 0.75) as q3 from ({long}) group by all) b
 join ({long}) d on b.{by} = d.{by} and b.Metric = d.Metric and v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)
 group by b.{by}, b.Metric, b.n, q1, med, q3"""


_SPLIT_MESSAGE = """select *, nullif(string_split(m, '_')[1], '') as Debug_Code, case when m is not null then substr(m, length(string_split(m, '_')[1]) + 2) end as Debug_Message
 from (select * exclude (Debug), unnest(case when Debug = '' then [null] else string_split(Debug, '&') end) as m from {source})"""

_FIELDS = "\\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"])

_TEXTS = {
    # scans, sinks, stored stages
    "scan_vcf": """select CHROM, POS, ID, REF, ALT, QUAL, FILTER, INFO, FORMAT, c.cells from vcf join
 (select k, string_agg(gt || ':' || ad || ':' || dp || ':' || gq || ':' || pl, ' ' order by place) as cells from cells0 group by k) c on vcf.ROW_ID = c.k""",
    "scan_vcf_gz": "select CHROM, POS, ID, REF, ALT, QUAL, INFO from vcf",
    "scan_vcf_blocks": "select row_number() over (order by ROW_ID) - 1 as row_no, CHROM, POS, ID, REF, ALT, QUAL, INFO from vcf",
    "vcf_header": f"""select 0::int as LINE, '##fileformat=VCFv4.2' as value union all select 1, '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">'
 union all select 2, replace('{_FIELDS}', '\\t', chr(9)) || chr(9) || string_agg(SampleID, chr(9) order by SAMPLE_POS) from samples""",
    "vcf_samples": "select SAMPLE_POS, SampleID from samples",
    "scan_gff": """select row_number() over (order by _row) - 1 as row_no, CHROM, Source, Type, feature_start as "Start", feature_end as "End", Score, Strand, Phase, Attributes from gff""",
    "scan_annot": """select row_number() over (partition by source order by _row) as row_no, source, proteinId, name from
 (select 'GO' as source, _row, proteinId::varchar as proteinId, goName as name from go union all select 'IPR', _row, proteinId::varchar, iprDesc from ipr
 union all select 'KEGG', _row, proteinId::varchar, definition from kegg union all select 'KOG', _row, proteinId::varchar, kogdefline from kog)""",
    "scan_csv": "select * from metadata",
    "scan_ids": "select SampleID from metadata",
    "typed_reload": "select CHROM, POS::double as POS, REF, ALT, ALT_IDX, QUAL, AF, QD, DS from exp_alleles",
    "sink_roundtrip": "select _row as row_no, proteinId, kogdefline from kog",
    "sites_only": "select CHROM, POS, ID, REF, ALT, QUAL, FILTER, INFO from vcf",
    "stage_reuse": f"select {_ALLELE}, ALT_IDX, AF from exp_alleles",
    "stage_by_content": f"select {_ALLELE}, ALT_IDX, AF from exp_alleles where AF >= 0.2",
    "range_layout": "select CHROM, count(*) as n, min(POS) as first_pos, max(POS) as last_pos, sum(POS)::bigint as sum_pos, 0::bigint as n_over from sites group by CHROM",
    # flattening
    "parse_info": """select CHROM, POS, ALT, list_text(INFO, 'AC') as AC, list_text(INFO, 'AF') as AF, AN::int as AN, DP::int as DP, DS, END_POS::int as "END", 60.25::double as MQ, QD, RAW_MQandDP from
 (select v.*, e.AN, e.DP, e.DS, e.QD, e.RAW_MQandDP, s.END_POS from vcf v join exp_alleles e on v.ROW_ID = e.k and e.ALT_IDX = 1 join sites s on s.k = e.k)""".replace(
        "list_text(INFO, 'AC')", "regexp_extract(INFO, '(?:^|;)AC=([^;]*)', 1)"
    ).replace("list_text(INFO, 'AF')", "regexp_extract(INFO, '(?:^|;)AF=([^;]*)', 1)"),
    "clean_ids": f"""select v.CHROM, v.POS, replace(regexp_extract(INFO, ';ANN=([^;]*)', 1), '{ANN_PREFIX}', '') as ANN, t.LOF, t.NMD
 from vcf v join exp_list_text t on v.ROW_ID = t.k""",
    "decompose_alleles": f"select {_ALLELE}, ALT_IDX, QUAL, AC, AF, AN, DP, DS, QD, RAW_MQandDP from exp_alleles",
    "explode_ann": f"select {_ALLELE}, ALT_IDX, ANN_IDX::int as ANN_IDX, {_ENTRY}, Debug from ann",
    "match_allele": f"select {_ALLELE}, ALT as Allele, Effect, Gene_ID from ann",
    "project_columns": f"select {_ALLELE}, {_ENTRY} from ann",
    "bad_records": """select k as ROW_ID, CHROM, POS, Reason from (select k, CHROM, POS, concat_ws(', ', case when k % 83 = 2 then 'AC length' end,
 case when k % 97 = 5 then 'ANN fields' end, case when k % 89 = 7 then 'LOF fields' end) as Reason from sites) where Reason <> ''""",
    "route_records": """select k as ROW_ID, CHROM, POS, Reason from (select k, CHROM, POS, concat_ws(', ', case when k % 83 = 2 then 'AC length' end,
 case when k % 97 = 5 then 'ANN fields' end, case when k % 89 = 7 then 'LOF fields' end, case when k % 79 = 11 then 'cell fields' end) as Reason from sites) where Reason <> ''""",
    "record_counts": """select unnest(['records', 'AC length', 'ANN fields', 'LOF fields', 'cell fields']) as Fault, unnest([count(*), count(*) filter (k % 83 = 2),
 count(*) filter (k % 97 = 5), count(*) filter (k % 89 = 7), count(*) filter (k % 79 = 11)]) as n from sites""",
    "info_keys": """select "Key", count(*) as n, count(*) filter (v is null) as n_flags, count(*) filter (len(string_split(v, ',')) > 1) as n_lists,
 count(*) filter (len(string_split(v, ',')) > 1 and len(string_split(v, ',')) <> alleles or len(string_split(v, ',')) = 1 and alleles > 1) as n_uneven,
 count(*) filter (regexp_full_match(v, '[0-9,]+')) as n_ints, count(*) filter (regexp_full_match(v, '[0-9,.]+')) as n_numbers
 from (select string_split(e, '=')[1] as "Key", case when e like '%=%' then substr(e, instr(e, '=') + 1) end as v, alleles from
 (select unnest(string_split(INFO, ';')) as e, len(string_split(ALT, ',')) as alleles from vcf)) group by "Key" """,
    "info_rest": """select k as ROW_ID, 'LENG' as "Key", '"' || cast(k % 7 as varchar) || '"' as "Value" from sites where k % 12 = 4
 union all select k, 'NOVEL', 'true' from sites where k % 24 = 4""",
    "info_discovered": """select k as ROW_ID, case when k % 12 = 4 then cast(k % 7 as int) end as LENG, k % 24 = 4 as NOVEL from sites""",
    "sample_rows": """select * exclude (FORMAT, ALT2) from vcf where ('0x' || substr(md5('42|' || ROW_ID), 1, 8))::bigint < round(0.2 * 4294967296)""",
    "explode_lof": "select CHROM, POS, ALT, Protein_ID, Gene_ID, Total_Transcripts_LOF, Percent_Transcripts_LOF from exp_lof",
    "explode_nmd": "select CHROM, POS, ALT, Protein_ID, Gene_ID, Total_Transcripts_NMD, Percent_Transcripts_NMD from exp_nmd",
    "join_lof_nmd": f"select {_ALLELE}, ALT_IDX, ANN_IDX::int as ANN_IDX, Effect, Gene_ID, {_LOSS} from ({_ALL_LOST})",
    "flag_lof_nmd": f"""select {_ALLELE}, ALT_IDX, ANN_IDX::int as ANN_IDX, Effect, Gene_ID, case when isLOF then t.LOF end as LOF,
 case when isLOF then Total_Transcripts_LOF end as Total_Transcripts_LOF, case when isLOF then Percent_Transcripts_LOF end as Percent_Transcripts_LOF,
 case when isNMD then t.NMD end as NMD, case when isNMD then Total_Transcripts_NMD end as Total_Transcripts_NMD,
 case when isNMD then Percent_Transcripts_NMD end as Percent_Transcripts_NMD, isLOF, isNMD
 from (select *, Total_Transcripts_LOF is not null and {_COUNTS} as isLOF, Total_Transcripts_NMD is not null and {_COUNTS} as isNMD from ({_ALL_LOST})) x
 join exp_list_text t on x.k = t.k""",
    "variant_type": f"select {_ALLELE}, {_VARIANT_TYPE} as Variant_Type from exp_alleles",
    "parse_debug": f"select {_ALLELE}, Effect, Protein_ID, Debug_Code, Debug_Message from ({_SPLIT_MESSAGE.format(source='ann')})",
    "debug_messages": f"select {_ALLELE}, Effect, Protein_ID, Debug_Message, Debug_Code from ({_SPLIT_MESSAGE.format(source='messages')})",
    "distinct_annotations": f"select {_ALLELE}, ALT_IDX, {_ENTRY} from (select distinct k, {_ALLELE}, ALT_IDX, {_ENTRY} from ann)",
    "split_annotations": "select * from split_ann",
    "infer_types": """select Effect, Impact, Protein_ID::double as Protein_ID, Gene_ID, nullif(HGVS_c, '') as HGVS_c, HGVS_p,
 nullif(Dist_to_Feature, '')::double as Dist_to_Feature, AF, QD, DS from ann""",
    # summaries
    "effect_counts": "select Effect, count(*) as n from split_eff group by Effect",
    "impact_distribution": """select Impact, n, pct, format('{:,}', n) || ' (' || regexp_replace(cast(cast(pct as decimal(20, 2)) as varchar), '\\.?0+$', '') || '%)' as label
 from (select Impact, count(*) as n, round_even(count(*) / (select count(*) from split_ann) * 100, 2) as pct from split_ann group by Impact)""",
    "type_effect_impact": "select Variant_Type, Effect, Impact, count(*) as n from split_eff group by all",
    "label_threshold": "select quantile_cont(n, 0.4) as threshold from (select count(*) as n from split_eff group by Variant_Type, Effect, Impact)",
    "debug_counts": f"""select Debug_Message, Effect, count(*) as n from (select Debug_Message, unnest(string_split(Effect, '&')) as Effect
 from ({_SPLIT_MESSAGE.format(source='messages')}) where Debug_Code is not null and Debug_Message <> '') group by all""",
    "row_totals": "select count(*) as n, 'n = ' || format('{:,}', count(*)) as label from split_ann",
    "qc_box_by_effect": _box("split_eff", "Effect"),
    "qc_box_by_type": _box("split_ann", "Variant_Type"),
    "qc_sketch_by_effect": "select Effect, Metric, count(*) as n, min(v) as least, max(v) as most, true as q1_inside, true as med_inside, true as q3_inside from ("
    + " union all ".join(f"select Effect, '{m}' as Metric, {m}::double as v from split_eff where {m} is not null" for m in ("AF", "QUAL", "DP", "QD", "AC"))
    + ") group by Effect, Metric",
    "kept_counts": """select Effect, Impact, count(*) as n from (select unnest(string_split(Effect, '&')) as Effect, Impact from
 (select distinct k, ALT_IDX, ALT, Effect, Impact, Protein_ID, Gene_ID, HGVS_c, HGVS_p, Dist_to_Feature from ann)) group by all""",
    "pretty_labels": """select Effect, count(*) as n, regexp_replace(replace(replace(replace(Effect, '_variant', ''), '_', ' '), '&', ' & '), '(?i)prime', '''', 'g') as label
 from split_ann group by Effect""",
    # record filters and tallies
    "high_impact": f"select {_ALLELE}, {_ENTRY} from ann where Impact = 'HIGH'",
    "filter_ann_gene": "select CHROM, POS, REF, ALT from vcf where ROW_ID in (select k from exp_entries where Gene_ID in ('gene_7', 'gene_70'))",
    "filter_ann_gene_set": """select CHROM, POS, REF, ALT from vcf where ROW_ID in
 (select k from exp_entries where Gene_ID in (select 'gene_' || (Protein_ID::bigint - 9000000) from wanted))""",
    "filter_lof_nmd": "select v.CHROM, v.POS, v.REF, v.ALT, t.LOF, t.NMD from vcf v join exp_list_text t on v.ROW_ID = t.k where coalesce(t.LOF, '') <> '' or coalesce(t.NMD, '') <> ''",
    "multiallelic_snps": f"select CHROM, POS, REF, ALT1 || ',' || ALT2 as ALT from ({_CLASSES}) where c1 = 'snp' and c2 = 'snp'",
    "multiallelic_indels": f"select CHROM, POS, REF, ALT1 || ',' || ALT2 as ALT from ({_CLASSES}) where c1 = 'indel' and c2 = 'indel'",
    "variant_counts": f"""select (select count(*) from samples) as n_samples, count(*) filter ({_has('snp')}) as n_snps, count(*) filter ({_has('indel')}) as n_indels, count(*) filter ({_has('mnp')}) as n_mnps,
 count(*) filter ({_has('other')}) as n_others, count(*) as n_sites from ({_CLASSES})""",
    "variant_stats": f"""with s as ({_CLASSES}) select 'records' as Section, count(*) as n from s union all select 'samples', count(*) from samples union all select 'no-ALTs', 0::bigint
 union all select 'SNPs', count(*) from s where {_has('snp')} union all select 'MNPs', count(*) from s where {_has('mnp')}
 union all select 'indels', count(*) from s where {_has('indel')} union all select 'others', count(*) from s where {_has('other')}
 union all select 'multiallelic sites', count(*) from s where c2 is not null
 union all select 'multiallelic SNP sites', count(*) from s where c1 = 'snp' and c2 = 'snp'""",
    "ts_tv": """select ts, tv, round(ts / nullif(tv, 0), 2) as ts_tv from (select count(*) filter (REF || ALT in ('AG', 'GA', 'CT', 'TC')) as ts,
 count(*) filter (REF || ALT not in ('AG', 'GA', 'CT', 'TC')) as tv from exp_alleles where length(REF) = 1 and length(ALT) = 1 and ALT <> '*')""",
    "substitution_counts": "select REF || '>' || ALT as Change, count(*) as n from exp_alleles where length(REF) = 1 and length(ALT) = 1 and ALT <> '*' group by all",
    "indel_lengths": f"select cast(length(ALT) - length(REF) as int) as Length, count(*) as n from (select REF, ALT, {_klass('REF', 'ALT')} as c from exp_alleles) where c = 'indel' group by all",
    "quality_histogram": f"""select floor(QUAL)::bigint as Quality, count(*) as n, count(*) filter ({_has('snp')}) as n_snps, count(*) filter ({_has('indel')}) as n_indels
 from ({_CLASSES}) group by all""",
    "depth_histogram": """select Depth::int as Depth, sum(s)::bigint as n_sites, sum(c)::bigint as n_genotypes from (select DP as Depth, 1 as s, 0 as c from sites
 union all select DP_S, 0, 1 from cells) where Depth is not null group by Depth""",
    "site_list": "select * from listed",
    "subset_sites": "select v.CHROM, v.POS, v.REF, v.ALT, (select count(*) from samples)::int as n_samples from vcf v semi join listed using (CHROM, POS)",
    "subset_sites_overlap": """select v.CHROM, v.POS, v.REF, v.ALT from vcf v join (select distinct s.k from sites s join listed l on l.CHROM = s.CHROM
 and l.POS + 1 between s.POS and greatest(s.POS + length(s.REF) - 1, s.END_POS)) c on v.ROW_ID = c.k""",
    "spans_on_genes": """select s.k as ROW_ID, s.CHROM, s.POS, g.ID, g.feature_start, g.feature_end from sites s join gff_wide g on g.CHROM = s.CHROM
 and g.Type = 'gene' and g.feature_start <= greatest(s.POS + length(s.REF) - 1, s.END_POS) and s.POS <= g.feature_end where s.k % 501 = 7 or length(s.REF) > 1""",
    # genes
    "gff_features": "select * exclude (_row), _row as row_no from gff_gene",
    "gff_fill": "select _row as row_no, Gene_ID, Protein_ID, Transcript_ID, Protein_Product from features",
    "collapse_annotations": "select * from collapsed",
    "search_terms": "select * from found",
    "term_table": f"""select distinct n.source, n.Protein_ID, t.term from (select distinct source, Protein_ID, name from
 (select 'GO' as source, proteinId::varchar as Protein_ID, goName as name from go union all select 'IPR', proteinId::varchar, iprDesc from ipr
 union all select 'KEGG', proteinId::varchar, definition from kegg union all select 'KOG', proteinId::varchar, kogdefline from kog)) n
 join (select p_brand as term from part union select p_type from part union select c_mktsegment from customer
 union select unnest([{", ".join("'" + t + "'" for t in SEARCH_TERMS)}])) t on contains(lower(n.name), lower(t.term))""",
    "proteins_of_interest": "select * from wanted",
    "full_join_annotations": "select * from proteins",
    "gene_annotations": "select * from genes",
    "annotate_override": """select _row as row_no, Protein_ID, case Protein_ID when '9000007' then coalesce(Protein_Product, 'NA') || ';patched product (Exo1)'
 when '9000009' then coalesce(Protein_Product, 'NA') || ';helicase' else Protein_Product end as Protein_Product from features""",
    "variants_in_genes": """select a.CHROM, a.POS, a.REF, a.ALT, a.Effect, a.Gene_ID, g.Type, g.feature_start, g.feature_end, g.GO from ann a
 join genes g on a.CHROM = g.CHROM and a.Protein_ID = g.Protein_ID and a.Gene_ID = g.Gene_ID and a.POS between g.feature_start and g.feature_end""",
    # calls
    "parse_calls": "select k as ROW_ID, place, GT, AD, DP_S, GQ, PL from cells",
    "ref_alt_depth": "select k as ROW_ID, place, AD_REF, AD_ALT, PL_REF, PL_ALT from calls",
    "calls_long": f"select c.k as ROW_ID, s.CHROM, s.POS, {_CALL} from calls c join sites s on c.k = s.k",
    "allele_call_counts": f"select k as ROW_ID, {_ALLELE}, ALT_IDX, N_ALT_GTS, N_CALLS from call_counts",
    "drop_singletons": f"select k as ROW_ID, {_ALLELE}, ALT_IDX, N_ALT_GTS, N_CALLS from call_counts where N_ALT_GTS > 1",
    "site_allele_summary": "select * from site_summary",
    "split_calls": f"""select h.k as ROW_ID, {_ALLELE}, ALT_IDX, Effect, N_ALT_GTS, N_CALLS, N_ALT_ALLELES, N_ALT_DISTINCT, ALT_SUMMARY, Total_Transcripts_LOF,
 Percent_Transcripts_LOF, isLOF, isNMD, {_CALL} from high_calls h join calls c on h.k = c.k""",
    "annotate_variants": """select a.CHROM, a.POS, a.REF, a.ALT, a.Effect, a.Gene_ID, a.Protein_ID, g.GO, g.IPR, g.KEGG, g.KOG, g.Protein_Product, g.feature_start
 from ann a left join gene_rows g on a.CHROM = g.CHROM and a.Protein_ID = g.Protein_ID and a.Gene_ID = g.Gene_ID""",
    "effect_severity": f"select {_ALLELE}, Effect, {_EFFECT_RANK} as Effect_Rank from ann",
    "merge_annotations": f"select Protein_ID, ID, {_MERGED} as Annotations from genes",
    "term_rank": f"select Protein_ID, ID, {_MATCHED} as Matched_Terms, {_ANNOT_RANK} as Annot_Rank from (select *, {_MERGED} as Annotations from genes)",
    "rank_variants": f"""select row_number() over (order by Comb_Rank nulls last, AF nulls last, N_ALT_ALLELES, k, ALT_IDX, ANN_N, Total_Transcripts_LOF nulls last,
 Percent_Transcripts_LOF nulls last, Total_Transcripts_NMD nulls last, Percent_Transcripts_NMD nulls last, ID nulls last) as Place, k as ROW_ID, {_ALLELE}, ALT_IDX, Effect, Gene_ID, Comb_Rank, Effect_Rank, Matched_Terms, Annot_Rank, AF, N_ALT_GTS, N_CALLS,
 N_ALT_ALLELES, Annotations, Total_Transcripts_LOF, Total_Transcripts_NMD from ranked""",
    # crosses
    "sample_index": "select SampleID, GametophyteCode, nullif(regexp_extract(GametophyteCode, '\\.([MF])\\.', 1), '') as Sex from (select distinct SampleID, GametophyteCode from metadata)",
    "sample_id_check": """select coalesce(a, b) as SampleID, case when b is null then 'metadata' else 'vcf' end as Found_In from (select distinct SampleID as a from metadata)
 full join (select distinct SampleID as b from samples) on a = b where a is null or b is null""",
    "calls_with_sample": f"select {_KEPT} from sampled",
    "filter_calls": f"select {_KEPT} from good",
    "both_sexes": f"select {_KEPT} from paired",
    "top_samples": f"select {_KEPT} from kept",
    "expand_crosses": f"""select F_ID, M_ID, "Cross", k as ROW_ID, {_ALLELE} from crossed""",
    "cross_table": f"""select F_ID, M_ID, "Cross", Comb_Rank, Effect_Rank, Matched_Terms, Annot_Rank, {_ALLELE}, AF, Effect, Gene_ID, Protein_ID, N_ALT_GTS,
 N_ALT_ALLELES, Annotations from crossed""",
    "best_crosses": """select * from (select row_number() over (order by first) as "Rank", "Cross", F_ID, M_ID from
 (select "Cross", F_ID, M_ID, min((gpos, mpos, fpos)) as first from crossed group by all)) where "Rank" <= 100""",
    "cross_list": """select row_number() over (order by first) as "Rank", "Cross", F_ID, M_ID from
 (select "Cross", F_ID, M_ID, min((gpos, mpos, fpos)) as first from crossed group by all)""",
}


def oracle_sql() -> dict[str, str]:
    """Query name -> SQL over the benchmark tables."""
    return {name: with_views(f"select * from ({text})", _MORE) for name, text in _TEXTS.items()}
