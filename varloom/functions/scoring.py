"""Severity, function terms and merged annotation text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _least(parts: list[Column]) -> Column:
    return parts[0] if len(parts) == 1 else F.least(*parts)


def effect_rank(effect: Column, severity: dict[str, int]) -> Column:
    """Lowest severity rank among the ``&``-parts of ``effect``; Infinity when none is known."""
    padded = F.concat(F.lit("&"), effect, F.lit("&"))
    ranks = [F.when(padded.contains(f"&{name}&"), F.lit(float(rank))) for name, rank in severity.items()]
    return F.coalesce(_least(ranks), F.lit(float("inf")))


def merge_annotations(*texts: Column) -> Column:
    """``;``-separated parts of all texts, each once, in order of first appearance."""
    empty = F.array().cast("array<string>")
    parts = F.concat(*[F.coalesce(F.split(text, ";"), empty) for text in texts])
    return F.array_join(F.array_distinct(parts), ";")


def matched_terms(text: Column, term_rank: dict[str, int]) -> Column:
    """Terms found in ``text``, ignoring case, joined in dictionary order; NULL when none."""
    lowered = F.lower(text)
    found = [F.when(lowered.contains(term.lower()), F.lit(term)) for term in term_rank]
    return F.nullif(F.concat_ws(", ", *found), F.lit(""))


def annotation_rank(text: Column, term_rank: dict[str, int]) -> Column:
    """Lowest rank among the terms found in ``text``; one more than the highest when none."""
    lowered = F.lower(text)
    ranks = [F.when(lowered.contains(term.lower()), F.lit(rank)) for term, rank in term_rank.items()]
    return F.coalesce(_least(ranks), F.lit(max(term_rank.values()) + 1))


def any_of(text: Column, words: list[str] | tuple[str, ...], ignore_case: bool = False) -> Column:
    """True when ``text`` holds any of ``words`` as plain text."""
    quoted = "|".join("\\Q" + word + "\\E" for word in words)
    return text.rlike(("(?i)" if ignore_case else "") + quoted)
