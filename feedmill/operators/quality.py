"""Landing checks and row accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.text import too_wide
from feedmill.operators.reshape import unpivot
from feedmill.operators.upsert import _key_names, repeated_keys, with_match_keys


def null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows without a value per required column; empty text counts as a value."""
    counts = df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return unpivot(
        counts, [], [{"column_name": F.lit(c), "violations": F.col(c)} for c in required]
    )


def width_violations(df: DataFrame, ids: Sequence[str], widths: dict[str, int]) -> DataFrame:
    """One row per cell that is longer than its column allows."""
    branches = [
        {
            "column_name": F.lit(c),
            "max_width": F.lit(w).cast("bigint"),
            "actual_width": F.length(c).cast("bigint"),
        }
        for c, w in widths.items()
    ]
    return unpivot(df, ids, branches, keep=F.col("actual_width") > F.col("max_width"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row as joins compare them, with the number of rows.

    Text keys come in their compared form. A NULL in the key equals nothing.
    """
    return repeated_keys(df, keys).withColumnsRenamed(dict(zip(_key_names(keys), keys)))


def row_fault(
    required: Sequence[str],
    widths: dict[str, int],
    typed: dict[str, Column],
    malformed: Column | None = None,
) -> Column:
    """First reason to refuse a landed row, or NULL.

    ``typed`` maps a column to its typed form: text that does not read is a fault.
    """
    tests: list[tuple[Column, str]] = []
    if malformed is not None:
        tests.append((malformed, "malformed"))
    tests += [(F.col(c).isNull(), f"required:{c}") for c in required]
    tests += [(too_wide(F.col(c), w), f"width:{c}") for c, w in widths.items()]
    tests += [(F.col(c).isNotNull() & t.isNull(), f"type:{c}") for c, t in typed.items()]
    return F.coalesce(*[F.when(test, F.lit(reason)) for test, reason in tests])


def audit_counts(
    stage: DataFrame, core: DataFrame, keys: Sequence[str], reject: Column
) -> DataFrame:
    """One row: stage rows scanned, rejected, matched in core and inserted.

    The core is reduced to its distinct keys, and stage rows are counted per key
    before they meet it: the join sees each key once.
    """
    names = _key_names(keys)
    per_key = (
        with_match_keys(stage.select(*keys, F.coalesce(reject, F.lit(False)).alias("_bad")), keys)
        .groupBy(*names)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count_if(F.col("_bad")).alias("_rejected"),
        )
    )
    present = with_match_keys(core.select(*keys), keys).select(*names).distinct()
    joined = per_key.join(present.withColumn("_hit", F.lit(True)), names, "left")
    good = F.col("_rows") - F.col("_rejected")

    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)

    return joined.agg(
        total(F.col("_rows"), "scanned"),
        total(F.col("_rejected"), "rejected"),
        total(F.when(F.col("_hit"), good).otherwise(0), "matched"),
        total(F.when(F.col("_hit").isNull(), good).otherwise(0), "inserted"),
    )
