"""Allele classes, substitutions and lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four A<->G and C<->T substitutions.
TRANSITIONS = ["AG", "GA", "CT", "TC"]


def variant_type(ref: Column, alt: Column) -> Column:
    """INDEL for ``*`` and for a change of length, else SNP; block substitutions count as SNP."""
    return F.when((alt == "*") | (F.length(ref) != F.length(alt)), "INDEL").otherwise("SNP")


def _shared_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix."""
    shorter = F.least(F.length(a), F.length(b))
    return F.aggregate(
        F.sequence(F.lit(0), shorter),
        F.lit(0),
        lambda n, i: F.when((i == n + 1) & (a.substr(i, F.lit(1)) == b.substr(i, F.lit(1))), i).otherwise(n),
    )


def allele_class(ref: Column, alt: Column) -> Column:
    """``snp``, ``mnp``, ``indel``, ``ref``, ``overlap`` or ``other`` of one REF/ALT pair.

    Same length: by the span between the first and the last mismatch. Different length: an indel
    when one block removed from the longer allele leaves the shorter one, else ``other``.
    """
    r, a = F.upper(ref), F.upper(alt)
    head = _shared_prefix(r, a)
    tail = _shared_prefix(F.reverse(r), F.reverse(a))
    shorter = F.least(F.length(r), F.length(a))
    return (
        F.when(alt == "*", "overlap")
        .when(alt.isNull() | (alt == ".") | (r == a), "ref")
        .when(~a.rlike("^[ACGTN]+$"), "other")
        .when((F.length(r) == 1) & (F.length(a) == 1), "snp")
        .when(
            F.length(r) == F.length(a),
            F.when(head + tail == shorter - 1, "snp").otherwise("mnp"),
        )
        .when(head + tail >= shorter, "indel")
        .otherwise("other")
    )


def substitution(ref: Column, alt: Column) -> Column:
    """``A>G`` of a single-base change; NULL for anything else."""
    single = (F.length(ref) == 1) & F.upper(alt).rlike("^[ACGT]$")
    return F.when(single, F.concat(F.upper(ref), F.lit(">"), F.upper(alt)))


def is_transition(ref: Column, alt: Column) -> Column:
    """True for a transition, false for a transversion, NULL when not a single-base change."""
    change = substitution(ref, alt)
    return F.when(change.isNotNull(), F.replace(change, F.lit(">"), F.lit("")).isin(TRANSITIONS))
