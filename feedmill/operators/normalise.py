"""Blank-to-NULL clean-up and audit columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.feeds import AUDIT
from feedmill.functions.text import blank_to_null, typed_null
from feedmill.functions.typing import load_stamp


def normalise(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn blanks into NULL in ``columns`` only, in one projection.

    Columns that are not listed keep their blanks.
    """
    return df.withColumns({c: blank_to_null(F.col(c)) for c in columns})


def fill_empty(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Empty cells are empty text, not NULL: the CSV parser loses the difference."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in columns})


def with_audit(df: DataFrame, load_ts, audit: Sequence[str] = AUDIT) -> DataFrame:
    """Append the audit columns, all holding the one load time."""
    stamp = load_stamp(load_ts)
    return df.select("*", *[stamp.alias(a) for a in audit])


def with_typed_nulls(df: DataFrame, nulls: dict[str, str]) -> DataFrame:
    """Append constant NULL columns with declared types."""
    return df.select("*", *[typed_null(t).alias(n) for n, t in nulls.items()])
