"""Decoding through dictionaries.

The joins carry no broadcast hint. A dictionary below the threshold is broadcast
by Catalyst; a larger one is joined by a shuffle, where adaptive execution splits
a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions.text import match_form
from feedmill.operators.upsert import split_join


def _keyed(df: DataFrame, columns: Sequence[str], prefix: str) -> tuple[DataFrame, list[str]]:
    names = [f"{prefix}{i}" for i in range(len(columns))]
    forms = [match_form(F.col(c)).alias(n) for c, n in zip(columns, names)]
    return df.select("*", *forms), names


def decode(
    df: DataFrame,
    dictionary: DataFrame,
    on: Sequence[tuple[str, str]],
    take: Sequence[str],
    how: str = "inner",
    prefix: str = "_d",
) -> DataFrame:
    """Join a dictionary on pairs of (row column, dictionary column).

    With ``inner`` rows that the dictionary lacks are dropped, and rows it has
    several times fan out. NULL matches nothing.
    """
    rows, names = _keyed(df, [a for a, _ in on], prefix)
    entries, _ = _keyed(dictionary, [b for _, b in on], prefix)
    taken = [F.col(c).alias(f"_taken_{c}") for c in take]
    joined = rows.join(entries.select(*names, *taken), names, how)
    return joined.select(*df.columns, *[F.col(f"_taken_{c}").alias(c) for c in take])


def unmapped(
    df: DataFrame,
    lookups: Sequence[tuple[str, DataFrame, Sequence[tuple[str, str]]]],
    reason: str = "missing",
) -> DataFrame:
    """Rows that an inner decode would lose, once each, with the lookups they miss.

    The dictionaries are reduced to their distinct keys first, so no row repeats.
    """
    out = df
    flags = []
    for i, (name, dictionary, on) in enumerate(lookups):
        out, names = _keyed(out, [a for a, _ in on], f"_u{i}_")
        entries, _ = _keyed(dictionary, [b for _, b in on], f"_u{i}_")
        found = f"_found{i}"
        entries = entries.select(*names).distinct().withColumn(found, F.lit(True))
        out = split_join(out, entries, names, "left")
        flags.append(F.when(F.col(found).isNull(), F.lit(name)))
    missing = F.concat_ws(",", *flags)
    return out.select(*df.columns, missing.alias(reason)).filter(F.col(reason) != "")
