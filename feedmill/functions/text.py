"""Text expressions with the comparison rules of the landing tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """NULL when the cell is empty or holds blanks only; otherwise unchanged."""
    return F.when(F.rtrim(c) != "", c)


def match_form(c: Column) -> Column:
    """The form in which text keys are compared: case and trailing blanks ignored.

    The key columns are Latin text, where this equals a case-insensitive,
    blank-padded collation. A plain string also hashes: joins, slices and
    aggregates on it all agree. NULL stays NULL and so matches nothing.
    """
    return F.lower(F.rtrim(c.cast("string")))


def same_text(a: Column, b: Column) -> Column:
    return match_form(a) == match_form(b)


def too_wide(c: Column, width: int) -> Column:
    return F.length(c) > width


def typed_null(type_name: str = "string") -> Column:
    """A NULL with a type: an untyped NULL cannot be written or unioned."""
    return F.lit(None).cast(type_name)
