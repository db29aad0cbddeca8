"""Wide to long. Every reshape reads its input once and shuffles nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot(
    df: DataFrame,
    ids: Sequence[str],
    branches: Sequence[dict[str, Column]],
    keep: Column | None = None,
) -> DataFrame:
    """One output row per input row and branch.

    A branch maps output names to expressions over the input row; all branches
    name the same columns with the same types. NULL measures are kept, unless
    ``keep``, a test on the output columns, drops the row.

    UNPIVOT runs as an Expand inside generated code. Exploding an array of
    structs gives the same rows but builds the array per input row. The
    DataFrame method takes one value column only, hence the SQL.
    """
    names = list(branches[0])
    wide = df.select(*ids, *[b[n].alias(f"_{i}_{n}") for i, b in enumerate(branches) for n in names])
    values = ", ".join(f"`{n}`" for n in names)
    groups = ", ".join(
        "(" + ", ".join(f"`_{i}_{n}`" for n in names) + f") AS `{i}`" for i in range(len(branches))
    )
    columns = ", ".join(f"`{c}`" for c in [*ids, *names])
    rows = df.sparkSession.sql(
        f"SELECT {columns} FROM {{wide}} "
        f"UNPIVOT INCLUDE NULLS (({values}) FOR `_branch` IN ({groups}))",
        wide=wide,
    )
    return rows if keep is None else rows.filter(keep)


def unpivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    measures: dict[str, int],
    *,
    key: str = "Component_ID",
    value: str = "Result_Value",
) -> DataFrame:
    """Measure columns to (key, value) rows; the key is a literal per column."""
    return unpivot(
        df,
        ids,
        [{key: F.lit(str(k)), value: F.col(c)} for c, k in measures.items()],
    )


def unpivot_with_companion(
    df: DataFrame,
    ids: Sequence[str],
    measures: dict[str, int],
    companions: dict[str, str],
    *,
    key: str = "Component_ID",
    value: str = "Predicted_Value",
    companion: str = "Spec_Min",
    companion_type: str = "string",
) -> DataFrame:
    """As :func:`unpivot_measures`, with a second value some measures carry."""

    def other(c: str) -> Column:
        source = F.col(companions[c]) if c in companions else F.lit(None)
        return source.cast(companion_type)

    return unpivot(
        df,
        ids,
        [
            {key: F.lit(str(k)), companion: other(c), value: F.col(c)}
            for c, k in measures.items()
        ],
    )


def unpivot_two_keys(
    df: DataFrame,
    ids: Sequence[str],
    measures: dict[str, tuple[int, int]],
    *,
    keys: tuple[str, str] = ("Material_Id", "Container_Id"),
    value: str = "Blend_Component_Volume",
) -> DataFrame:
    """Measure columns whose name stands for two literal keys."""
    return unpivot(
        df,
        ids,
        [
            {keys[0]: F.lit(str(a)), keys[1]: F.lit(str(b)), value: F.col(c)}
            for c, (a, b) in measures.items()
        ],
    )


def unpivot_pairs(
    df: DataFrame,
    ids: Sequence[str],
    pairs: Sequence[tuple[str, str]],
    *,
    tag: str = "Tag_ID",
    value: str = "Tag_Value",
) -> DataFrame:
    """(tag, value) column pairs to rows; pairs without a tag are dropped."""
    return unpivot(
        df,
        ids,
        [{tag: F.col(t), value: F.col(v)} for t, v in pairs],
        keep=F.rtrim(tag) != "",
    )
