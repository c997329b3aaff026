"""Fields of one ``GT:AD:DP:GQ:PL`` cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from varloom.params import CALL_FIELDS


def present(value: Column) -> Column:
    """NULL for a value that holds a dot."""
    return F.when(~value.contains("."), value)


#: FORMAT of the fixed layout.
FIXED_FORMAT = ":".join(CALL_FIELDS.values())


def call_places(text: Column) -> Column:
    """Where the call fields are in the cells of a record with FORMAT ``text``: a struct of places, NULL if absent.

    Evaluate it once per record, never inside a function over its cells.
    """
    keys = F.split(text, ":")
    fixed = text == FIXED_FORMAT

    def place(at: int, key: str) -> Column:
        return F.when(fixed, F.lit(at)).otherwise(F.nullif(F.array_position(keys, key), F.lit(0)).cast("int") - 1)

    named = [(F.lit(name), place(at, key)) for at, (name, key) in enumerate(CALL_FIELDS.items())]
    return F.named_struct(*[part for pair in named for part in pair])


def call_columns(parts: Column, places: Column | None = None) -> dict[str, Column]:
    """Columns GT, AD, DP_S, GQ, PL from the split cell.

    ``places`` is what :func:`call_places` says of the record, for files whose layout varies; without it
    the layout is the fixed one. AD keeps its text as it is; the others turn dots into NULL, and GT, DP_S
    and GQ become integers.
    """
    raw = {name: F.get(parts, F.lit(at) if places is None else places[name]) for at, name in enumerate(CALL_FIELDS)}
    return {
        "GT": present(raw["GT"]).try_cast("int"),
        "AD": raw["AD"],
        "DP_S": present(raw["DP_S"]).try_cast("int"),
        "GQ": present(raw["GQ"]).try_cast("int"),
        "PL": present(raw["PL"]),
    }


def ref_alt_columns(gt: Column, ad: Column, pl: Column) -> dict[str, Column]:
    """Depth and likelihood of the reference allele and of the called allele."""

    def number(text: Column) -> Column:
        # A failing cast is slow, so the usual missing value is sorted out before it.
        return F.nullif(text, F.lit(".")).try_cast("int")

    def first(values: Column) -> Column:
        return F.when(gt.isNotNull(), number(F.substring_index(values, ",", 1)))

    def called(values: Column) -> Column:
        return F.when(gt != 0, number(F.get(F.split(values, ","), gt)))

    return {"AD_REF": first(ad), "AD_ALT": called(ad), "PL_REF": first(pl), "PL_ALT": called(pl)}
