"""Full reload and scoped replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.feeds import AUDIT
from feedmill.operators.normalise import with_audit


def number_between(c: Column, low: int, high: int) -> Column:
    """Inclusive range test on an id that is stored as text.

    An id that is not a number gives NULL, which is outside the range.
    """
    return F.trim(c).try_cast("decimal(38,6)").between(low, high)


def reload(
    stage: DataFrame, columns: Sequence[str], load_ts, audit: Sequence[str] = AUDIT
) -> DataFrame:
    """The table after a full reload: the stage's columns in core order."""
    return with_audit(stage.select(*columns), load_ts, audit)


def replace_where(core: DataFrame, scope: Column, rows: DataFrame) -> DataFrame:
    """Drop the core rows in ``scope`` and append ``rows``, wherever they belong.

    Rows for which the test is NULL stay. The appended rows are not held to the
    scope. Two scans and a union: nothing is shuffled.
    """
    kept = core.filter(~F.coalesce(scope, F.lit(False)))
    return kept.unionByName(rows.select(*core.columns))
