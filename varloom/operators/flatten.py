"""From raw VCF text fields to one row per allele and annotation.

A *record* is one VCF line: ``ROW_ID, CHROM, POS, ID, REF, ALT, QUAL, FILTER, INFO`` and, with
genotypes, ``FORMAT`` and ``CELLS`` (the sample cells, in header order). An *allele* row is one
record and one ALT. An *annotation* row is one allele and one ANN entry for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from varloom.functions.alleles import variant_type
from varloom.functions.scoring import any_of
from varloom.functions.text import blank_to_null, separators
from varloom.params import ANN_FIELDS, CALL_FIELDS, INFO_SCHEMA, LOF_EFFECTS, LOF_FIELDS, MODES, NMD_FIELDS

# What makes LOF and NMD entries belong to an annotation row.
GENE_KEYS = ["CHROM", "POS", "ALT", "Gene_ID", "Protein_ID"]
LOF_COLUMNS = ["LOF", "Total_Transcripts_LOF", "Percent_Transcripts_LOF"]
NMD_COLUMNS = ["NMD", "Total_Transcripts_NMD", "Percent_Transcripts_NMD"]


def drop_columns(df: DataFrame, *names: str, prefixes: tuple = (), suffixes: tuple = ()) -> DataFrame:
    """Drop columns by name, prefix or suffix."""
    gone = set(names) | {c for c in df.columns if c.startswith(tuple(prefixes)) or c.endswith(tuple(suffixes))}
    return df.select([c for c in df.columns if c not in gone])


#: Column of INFO keys that the schema does not have.
INFO_REST = "INFO_REST"


def _keyed(info: str | Column = "INFO") -> Column:
    return F.str_to_map(info, F.lit(";"), F.lit("="))


def parse_info(
    records: DataFrame, schema: dict[str, tuple[str, str]] = INFO_SCHEMA, rest: str | None = None
) -> DataFrame:
    """Turn INFO into one column per key of ``schema``.

    Per-allele keys stay text until :func:`decompose_alleles`. A flag is true when present. Keys outside
    the schema go to the VARIANT column ``rest``, if it is named: an object of their texts, true for those
    without a value, and NULL where a record has none. Few records have any, so a record is first tested
    for them by its keys alone. :func:`discover_schema` declares what a file has instead.
    """

    def typed(key: str, kind: str, number: str) -> str:
        if number == "0":
            return f"map_contains_key(_info, '{key}') as `{key}`"
        value = f"try_element_at(_info, '{key}')"
        return f"{value} as `{key}`" if number == "A" or kind == "string" else f"try_cast({value} as {kind}) as `{key}`"

    others = [f"`{c}`" for c in records.columns if c != "INFO"]
    # An empty INFO is one key without a name.
    keyed = records.withColumn("_info", _keyed())
    columns = [F.expr(typed(k, t, n)) for k, (t, n) in schema.items()]
    if rest:
        known = F.array(*[F.lit(k) for k in schema], F.lit(""), F.lit("."))
        unknown = F.map_filter("_info", lambda k, _: ~F.array_contains(known, k))
        value = F.transform_values(unknown, lambda _, v: F.coalesce(v.cast("variant"), F.lit(True).cast("variant")))
        found = F.size(F.array_except(F.map_keys("_info"), known)) > 0
        columns.append(F.when(found, F.to_variant_object(value)).alias(rest))
    return keyed.select(*[F.expr(c) for c in others], *columns)


def info_keys(records: DataFrame) -> DataFrame:
    """The INFO keys that occur, one row each: what :func:`discover_schema` decides by.

    ``n`` entries; ``n_flags`` without a value; ``n_lists`` with commas; ``n_uneven`` whose number of values
    is neither one nor that of the alleles; ``n_ints`` and ``n_numbers`` whose values are all whole numbers,
    or numbers. Counted before the shuffle: a task sends one row per key.
    """
    alleles = F.size(F.split("ALT", ","))
    rows = records.select(alleles.alias("_alleles"), F.explode(F.split("INFO", ";")).alias("_entry"))
    at = F.instr("_entry", "=")
    rows = rows.select(
        "_alleles",
        F.when(at > 0, F.left("_entry", at - 1)).otherwise(F.col("_entry")).alias("Key"),
        F.when(at > 0, F.substring("_entry", at + 1, F.length("_entry"))).alias("_value"),
    ).filter(~F.col("Key").isin("", "."))
    values = F.size(F.split("_value", ","))
    whole = F.col("_value").rlike(r"^[+-]?[0-9]{1,9}(?:,[+-]?[0-9]{1,9})*$")
    number = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
    return rows.groupBy("Key").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("_value").isNull()).alias("n_flags"),
        F.count_if(values > 1).alias("n_lists"),
        F.count_if((values > 1) & (values != F.col("_alleles")) | (values == 1) & (F.col("_alleles") > 1)).alias("n_uneven"),
        F.count_if(whole).alias("n_ints"),
        F.count_if(F.col("_value").rlike(rf"^{number}(?:,{number})*$")).alias("n_numbers"),
    )


def discover_schema(
    records: DataFrame, declared: dict[str, tuple[str, str]] = INFO_SCHEMA, most: int = 10_000
) -> dict[str, tuple[str, str]]:
    """``declared``, and the keys of ``records`` that it lacks, in order of their names.

    A key that never has a value is a flag; one that has as many values as alleles in every record, and
    several somewhere, is per allele; any other list is text. Keys are whole numbers, numbers or text, by
    all their values. A file with more than ``most`` other keys is refused: they would be columns.
    """
    found = info_keys(records).filter(~F.col("Key").isin(*declared)).orderBy("Key").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} INFO keys are not declared: read them as one column (rest)")
    schema = dict(declared)
    for key in found:
        valued = key.n - key.n_flags
        kind = "int" if key.n_ints == valued else "double" if key.n_numbers == valued else "string"
        if not valued:
            schema[key.Key] = ("boolean", "0")
        elif not key.n_lists:
            schema[key.Key] = (kind, "1")
        else:
            schema[key.Key] = (kind, "A") if not key.n_uneven else ("string", ".")
    return schema


def clean_ids(records: DataFrame, ann_prefix: str | None = None, list_prefix: str | None = None) -> DataFrame:
    """Strip the ID prefixes from ANN, LOF and NMD and the parentheses from LOF and NMD.

    The ANN prefix holds pipes, so this comes before ANN is split.
    """

    def strip(text: Column, prefix: str | None) -> Column:
        return F.replace(text, F.lit(prefix), F.lit("")) if prefix else text

    def bare(name: str) -> Column:
        return strip(F.translate(F.col(name), "()", ""), list_prefix)

    cleaned = {"ANN": strip(F.col("ANN"), ann_prefix)} if "ANN" in records.columns else {}
    return records.withColumns(cleaned | {c: bare(c) for c in ("LOF", "NMD") if c in records.columns})


def _per_allele(schema: dict[str, tuple[str, str]]) -> dict[str, str]:
    return {key: kind for key, (kind, number) in schema.items() if number == "A"}


def refused(bad: Column, message: Column, value: Column) -> Column:
    """``value``, unless ``bad``: then the job ends with ``message``, where the value is asked for."""
    return F.when(bad, F.raise_error(message)).otherwise(value)


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode}")


def uneven_list(key: str) -> Column:
    """Whether a per-allele list has neither one value nor one per allele; false where it is missing."""
    size = F.size(F.split(key, ","))
    return F.coalesce(F.col(key).isNotNull() & (size != 1) & (size != F.size(F.split("ALT", ","))), F.lit(False))


def decompose_alleles(
    records: DataFrame, schema: dict[str, tuple[str, str]] = INFO_SCHEMA, mode: str = "permissive"
) -> DataFrame:
    """One row per ALT, with its 1-based ``ALT_IDX`` and its own value of each per-allele key.

    A single value is repeated for every allele. Lists of any other length give NULL beyond their
    end, and :func:`bad_records` finds such lines; in failfast mode they end the job.
    """
    check_mode(mode)
    keys = {k: t for k, t in _per_allele(schema).items() if k in records.columns}
    alts = F.split("ALT", ",")
    if mode == "failfast" and keys:
        bad = F.array_compact(F.array(*[F.when(uneven_list(k), F.lit(k)) for k in keys]))
        message = F.concat(F.lit("per-allele INFO of another length than ALT: "), F.array_join(bad, ", "), F.lit(" at "), "CHROM", F.lit(":"), "POS")
        alts = refused(F.size(bad) > 0, message, alts)
    rows = records.select("*", F.posexplode(alts).alias("_pos", "_alt"))

    def own(key: str, kind: str) -> str:
        values = f"split(`{key}`, ',')"
        return f"try_cast(get({values}, if(size({values}) = 1, 0, _pos)) as {kind}) as `{key}`"

    out = []
    for name in records.columns:
        if name == "ALT":
            out += ["_alt as ALT", "_pos + 1 as ALT_IDX"]
        else:
            out.append(own(name, keys[name]) if name in keys else f"`{name}`")
    return rows.selectExpr(*out)


def record_faults(columns: list[str], schema: dict[str, tuple[str, str]] = INFO_SCHEMA) -> dict[str, Column]:
    """What can be wrong with a record that has ``columns``: fault -> whether it is there.

    For records with INFO parsed and IDs cleaned: the length of per-allele lists, the field count of ANN,
    LOF and NMD entries and, where there are genotypes, of every cell.
    """

    def uneven(name: str, want: int | Column, between: str = "|") -> Column:
        entries = F.split(name, ",") if name != "CELLS" else F.col(name)
        return F.coalesce(F.exists(entries, lambda entry: separators(entry, between) != want - 1), F.lit(False))

    faults = {f"{k} length": uneven_list(k) for k in _per_allele(schema) if k in columns}
    for name, want in (("ANN", len(ANN_FIELDS)), ("LOF", len(LOF_FIELDS)), ("NMD", len(NMD_FIELDS))):
        if name in columns:
            faults[f"{name} fields"] = uneven(name, want)
    if "CELLS" in columns:
        want_cells = separators(F.col("FORMAT"), ":") + 1 if "FORMAT" in columns else F.lit(len(CALL_FIELDS))
        faults["cell fields"] = uneven("CELLS", want_cells, ":")
    return faults


def bad_records(records: DataFrame, schema: dict[str, tuple[str, str]] = INFO_SCHEMA) -> DataFrame:
    """Records that cannot be split cleanly, with the reason: see :func:`record_faults`."""
    tests = [F.when(bad, fault) for fault, bad in record_faults(records.columns, schema).items()]
    return records.withColumn("Reason", F.concat_ws(", ", *tests)).filter(F.col("Reason") != "")


def observed(records: DataFrame, counts: Observation, schema: dict[str, tuple[str, str]] = INFO_SCHEMA) -> DataFrame:
    """``records`` as they are; ``counts`` gets ``records`` and the number with each fault, as they pass by.

    The numbers are there after the first action on the result, which they cost no pass of.
    """
    faults = record_faults(records.columns, schema)
    return records.observe(counts, F.count("*").alias("records"), *[F.count_if(bad).alias(fault) for fault, bad in faults.items()])


def route_records(
    records: DataFrame, path: str, schema: dict[str, tuple[str, str]] = INFO_SCHEMA, mode: str = "permissive"
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Store ``records`` once, split by whether they are malformed: all of them, the malformed ones, and counts.

    One scan tests, counts and writes each record; the malformed ones, with ``Reason``, lie in a folder of
    their own. In failfast mode the first of them ends the job.
    """
    check_mode(mode)
    counts = Observation("records")
    tests = [F.when(bad, fault) for fault, bad in record_faults(records.columns, schema).items()]
    reason = F.concat_ws(", ", *tests)
    if mode == "failfast":
        message = F.concat(F.lit("malformed record at "), "CHROM", F.lit(":"), "POS", F.lit(": "), reason)
        reason = refused(reason != "", message, reason)
    routed = observed(records, counts, schema).withColumn("Reason", reason).withColumn("malformed", F.col("Reason") != "")
    routed.write.partitionBy("malformed").parquet(path)
    stored = records.sparkSession.read.schema(routed.schema).parquet(path)
    return stored.drop("Reason", "malformed"), stored.filter("malformed").drop("malformed"), counts.get


def _entries(rows: DataFrame, want: int, mode: str, what: str) -> DataFrame:
    """Split ``_entry`` into ``_parts``. A wrong field count drops the entry or, in failfast mode, ends the job."""
    check_mode(mode)
    pipes = separators(F.col("_entry"), "|")
    parts = F.split("_entry", "\\|")
    if mode == "failfast":
        message = F.concat(F.lit(f"{what}: expected {want} fields in "), F.col("_entry"))
        parts = F.when(pipes == want - 1, parts).otherwise(F.raise_error(message))
    else:
        rows = rows.filter(pipes == want - 1)
    return rows.withColumn("_parts", parts).drop("_entry")


def explode_ann(
    alleles: DataFrame, matched: bool = True, distinct: bool = False, mode: str = "permissive"
) -> DataFrame:
    """One row per ANN entry whose allele is the row's ALT, with its fields as columns.

    ``matched=False`` gives every entry of the record to each of its alleles. ``ANN_IDX`` is the
    entry's place in the record's list. With ``distinct`` the messages are cut off and entries
    that are then the same count once: all rows of one record come from one list, so this needs
    no shuffle. Entries with a wrong field count are left out, see :func:`bad_records`; in
    failfast mode they end the job.
    """
    names = list(ANN_FIELDS)
    entries = F.split("ANN", ",")
    if distinct:
        # Blank the last of 16 fields; an entry of any other length is as it was and fails the count below.
        cut = F.regexp_replace("ANN", r"((?:^|,)(?:[^|,]*\|){15})[^|,]*(?=,|$)", "$1")
        entries = F.array_distinct(F.split(cut, ","))
    rest = [c for c in alleles.columns if c != "ANN"]
    rows = alleles.select(*rest, F.posexplode(entries).alias("_pos", "_entry"))
    if matched and mode != "failfast":
        rows = rows.filter(F.col("_entry").startswith(F.concat("ALT", F.lit("|"))))
    rows = _entries(rows, len(names), mode, "ANN")
    fields = [f"get(_parts, {i}) as {n}" for i, n in enumerate(names[:-1] if distinct else names)]
    rows = rows.selectExpr(*[f"`{c}`" for c in rest], "_pos + 1 as ANN_IDX", *fields)
    return match_allele(rows) if matched and mode == "failfast" else rows


def match_allele(entries: DataFrame) -> DataFrame:
    """Keep annotation rows that describe the row's own ALT."""
    return entries.filter(F.col("Allele") == F.col("ALT"))


def _explode_list(alleles: DataFrame, name: str, fields: list[str], mode: str) -> DataFrame:
    site = ["CHROM", "POS", "ALT"]
    rows = alleles.filter(F.col(name).isNotNull()).select(*site, F.explode(F.split(name, ",")).alias("_entry"))
    rows = _entries(rows, len(fields), mode, name)
    return rows.selectExpr(*site, *[f"get(_parts, {i}) as {f}" for i, f in enumerate(fields)])


def explode_lof(alleles: DataFrame, mode: str = "permissive") -> DataFrame:
    """One row per allele and LOF entry. The entries are not split by allele."""
    return _explode_list(alleles, "LOF", LOF_FIELDS, mode)


def explode_nmd(alleles: DataFrame, mode: str = "permissive") -> DataFrame:
    """One row per allele and NMD entry. The entries are not split by allele."""
    return _explode_list(alleles, "NMD", NMD_FIELDS, mode)


def join_lof_nmd(annotations: DataFrame, lof: DataFrame, nmd: DataFrame, null_safe: bool = False) -> DataFrame:
    """Left join of the LOF and NMD entries of the same site, allele, gene and protein.

    ``null_safe`` also lets missing keys match each other.
    """
    out = annotations
    for side in (lof, nmd):
        if null_safe:
            right = side.select([F.col(c).alias(f"_r_{c}") if c in GENE_KEYS else F.col(c) for c in side.columns])
            match = [out[c].eqNullSafe(right[f"_r_{c}"]) for c in GENE_KEYS]
            out = out.join(right, match, "left").drop(*[f"_r_{c}" for c in GENE_KEYS])
        else:
            out = out.join(side, GENE_KEYS, "left")
    return out


def join_counted_lof_nmd(
    annotations: DataFrame, lof: DataFrame, nmd: DataFrame, effects: list[str] | tuple = LOF_EFFECTS
) -> DataFrame:
    """:func:`join_lof_nmd`, then :func:`flag_lof_nmd`, then distinct, without the last shuffle.

    Rows whose effect does not count lose their LOF and NMD values anyway, so they are kept from
    matching; equal entries are merged before they are joined. No row is then made twice.
    """
    rows = annotations.withColumn("_counts", any_of(F.col("Effect"), effects) & F.col("HGVS_c").isNotNull())
    for side in (lof, nmd):
        # Numbers first: 1.0 and 1.00 are one entry.
        right = blank_fields(side).distinct().withColumn("_counts", F.lit(True))
        rows = rows.join(right, [*GENE_KEYS, "_counts"], "left")
    return flag_lof_nmd(rows.drop("_counts"), effects)


def flag_lof_nmd(joined: DataFrame, effects: list[str] | tuple = LOF_EFFECTS) -> DataFrame:
    """Add isLOF and isNMD; blank the LOF and NMD columns where they are false."""
    counts = any_of(F.col("Effect"), effects) & F.col("HGVS_c").isNotNull()
    flags = {
        "isLOF": F.coalesce(F.col("Total_Transcripts_LOF").isNotNull() & counts, F.lit(False)),
        "isNMD": F.coalesce(F.col("Total_Transcripts_NMD").isNotNull() & counts, F.lit(False)),
    }
    flagged = joined.withColumns(flags)
    return flagged.withColumns(
        {c: F.when(F.col("isLOF"), F.col(c)) for c in LOF_COLUMNS if c in joined.columns}
        | {c: F.when(F.col("isNMD"), F.col(c)) for c in NMD_COLUMNS if c in joined.columns}
    )


def blank_fields(annotations: DataFrame) -> DataFrame:
    """Empty ANN fields become NULL and transcript counts and shares become numbers.

    Comes after :func:`flag_lof_nmd`, which counts an empty HGVS field as present.
    """
    numbers = {f"Total_Transcripts_{kind}": "int" for kind in ("LOF", "NMD")}
    numbers |= {f"Percent_Transcripts_{kind}": "double" for kind in ("LOF", "NMD")}

    def column(name: str) -> str:
        if name in ANN_FIELDS:
            return f"nullif(`{name}`, '') as `{name}`"
        return f"try_cast(`{name}` as {numbers[name]}) as `{name}`" if name in numbers else f"`{name}`"

    return annotations.selectExpr(*[column(c) for c in annotations.columns])


def add_variant_type(alleles: DataFrame) -> DataFrame:
    """Add ``Variant_Type``."""
    return alleles.withColumn("Variant_Type", variant_type(F.col("REF"), F.col("ALT")))


def parse_debug(annotations: DataFrame) -> DataFrame:
    """One row per message of ``Debug``; rows without messages stay, with NULLs."""
    rest = [c for c in annotations.columns if c != "Debug"]
    rows = annotations.select(*rest, F.explode_outer(F.split(blank_to_null(F.col("Debug")), "&")).alias("_message"))
    parts = F.split("_message", "_", 2)
    return rows.select(
        *rest,
        F.get(parts, F.lit(0)).alias("Debug_Code"),
        F.when(F.col("_message").isNotNull(), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("Debug_Message"),
    )


def explode_effects(annotations: DataFrame) -> DataFrame:
    """One row per ``&``-part of Effect."""
    return annotations.withColumn("Effect", F.explode(F.split("Effect", "&")))


def distinct_annotations(annotations: DataFrame) -> DataFrame:
    """Drop the message columns and the list index, then keep each row once.

    VARIANT columns become their JSON text, whose keys are in order: variants have no equality.
    """
    rows = drop_columns(annotations, "ANN_IDX", prefixes=("Debug",))
    return rows.withColumns({f.name: F.to_json(f.name) for f in rows.schema.fields if f.dataType.typeName() == "variant"}).distinct()
