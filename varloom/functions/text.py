"""Labels, codes and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pretty_label(label: Column) -> Column:
    """Readable form of an effect or message code."""
    shown = F.replace(label, F.lit("_variant"), F.lit(""))
    shown = F.replace(shown, F.lit("_"), F.lit(" "))
    shown = F.replace(shown, F.lit("&"), F.lit(" & "))
    return F.regexp_replace(shown, "(?i)prime", "'")


def sex_from_code(code: Column) -> Column:
    """``M`` or ``F`` standing between two dots; NULL when there is none."""
    return F.regexp_substr(code, F.lit(r"(?<=\.)[MF](?=\.)"))


def comma_number(n: Column) -> Column:
    """``1234567`` as ``1,234,567``."""
    return F.format_number(n, 0)


def percent(n: Column, total: Column) -> Column:
    """``n`` as a percentage of ``total`` with two digits, halves to even."""
    return F.bround(n / total * 100, 2)


def blank_to_null(text: Column) -> Column:
    """NULL for empty text."""
    return F.nullif(text, F.lit(""))


def reloaded(text: Column) -> Column:
    """Text as it reads back from a TSV: empty and ``NA`` are missing."""
    return F.when(text.isin("", "NA"), None).otherwise(text)


def separators(text: Column, mark: str) -> Column:
    """How often the single character ``mark`` occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
