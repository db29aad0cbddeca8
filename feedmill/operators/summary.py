"""Maintained aggregates, the price-kind pivot and the last arrival per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.operators.keyfilter import key_filter, might_hold
from feedmill.operators.upsert import _key_names, with_match_keys

#: A day's state: what is needed to add readings to it and to take readings from it.
STATE = ("Readings", "Numbers", "Number_Sum", "Min_Value", "Max_Value", "Last_Stamp", "Last_Value")
STALE = "_stale"


def daily_states(
    readings: DataFrame, by: Sequence[str], stamp: str, value: str, day: str = "Reading_Date"
) -> DataFrame:
    """State per group and day: readings, numbers, their exact sum, bounds, and the last number.

    Values that are not numbers count as readings and enter nothing else. The sum
    is taken in decimals, so the result does not depend on the order of rows. All
    states have a fixed size: the plan hashes and combines before the shuffle, so
    a hot tag costs one partial row per task.
    """
    raw = F.col(value)
    if isinstance(readings.schema[value].dataType, T.StringType):
        raw = F.trim(raw)
    exact, number = raw.try_cast("decimal(28,6)"), raw.try_cast("double")
    numbered = F.when(number.isNotNull(), F.col(stamp))
    return (
        readings.withColumn(day, F.col(stamp).cast("date"))
        .groupBy(*by, day)
        .agg(
            F.count(F.lit(1)).alias("Readings"),
            F.count(exact).alias("Numbers"),
            F.sum(exact).alias("Number_Sum"),
            F.min(number).alias("Min_Value"),
            F.max(number).alias("Max_Value"),
            F.max(numbered).alias("Last_Stamp"),
            F.max_by(number, numbered).alias("Last_Value"),
        )
    )


def average() -> Column:
    return F.when(F.col("Numbers") > 0, F.col("Number_Sum").cast("double") / F.col("Numbers"))


def daily_summary(
    readings: DataFrame, by: Sequence[str], stamp: str, value: str, day: str = "Reading_Date"
) -> DataFrame:
    """Count, minimum, maximum, average and last value per group and day.

    Our definition of the aggregate the sensor job maintains.
    """
    states = daily_states(readings, by, stamp, value, day).withColumn("Avg_Value", average())
    return states.select(*by, day, "Readings", "Min_Value", "Max_Value", "Avg_Value", "Last_Value")


def merge_states(
    states: DataFrame, added: DataFrame, retracted: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """States after readings were added and others taken away, and whether they are stale.

    All three are states with one row per key. A state is stale if its minimum,
    maximum or last number was taken away and what was added does not replace it:
    only then the day's readings have to be looked at. A state without readings is dropped.
    """
    old, new, gone = ({c: f"{p}{c}" for c in STATE} for p in ("_o_", "_a_", "_r_"))
    joined = (
        states.withColumnsRenamed(old)
        .join(added.withColumnsRenamed(new), list(keys), "full")
        .join(retracted.withColumnsRenamed(gone), list(keys), "left")
    )

    def each(name: str) -> tuple[Column, Column, Column]:
        return F.col(old[name]), F.col(new[name]), F.col(gone[name])

    def total(name: str) -> Column:
        o, a, r = (F.coalesce(c, F.lit(0)) for c in each(name))
        return (o + a - r).cast(states.schema[name].dataType)

    def lost(name: str, holds) -> Column:
        """Whether the bound was taken away and nothing that was added holds it."""
        o, a, r = each(name)
        return F.coalesce(r == o, F.lit(False)) & ~F.coalesce(holds(a, o), F.lit(False))

    o_at, a_at, _ = each("Last_Stamp")
    later = F.coalesce(a_at >= o_at, o_at.isNull())
    stale = (
        lost("Min_Value", lambda a, o: a <= o)
        | lost("Max_Value", lambda a, o: a >= o)
        | lost("Last_Stamp", lambda a, o: a >= o)
    )
    merged = joined.select(
        *keys,
        total("Readings").alias("Readings"),
        total("Numbers").alias("Numbers"),
        F.when(total("Numbers") > 0, total("Number_Sum")).alias("Number_Sum"),
        F.least(*each("Min_Value")[:2]).alias("Min_Value"),
        F.greatest(*each("Max_Value")[:2]).alias("Max_Value"),
        F.when(later, a_at).otherwise(o_at).alias("Last_Stamp"),
        F.when(later, F.col(new["Last_Value"])).otherwise(F.col(old["Last_Value"])).alias("Last_Value"),
        stale.alias(STALE),
    )
    return merged.filter("Readings > 0")


def pivot_kinds(
    df: DataFrame, by: Sequence[str], kind: Column, value: Column, kinds: dict[str, str]
) -> DataFrame:
    """One column per kind: the highest value of that kind in the group.

    The kinds are fixed, so no pass is spent on finding them.
    """
    return df.groupBy(*by).agg(
        *[F.max(F.when(kind == k, value)).alias(name) for k, name in kinds.items()]
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that arrived last for each compared key, without the order columns.

    Repeated keys are found by a hash count; a Bloom filter of them lets all other rows pass as they are, so only
    rows of repeated keys are sorted. ``df`` is read twice: it should be settled.
    """
    columns = [c for c in df.columns if c not in set(order)]
    names = _key_names(keys)
    keyed = with_match_keys(df, keys).withColumn("_h", F.xxhash64(*names))
    repeated = keyed.groupBy("_h").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    count = repeated.count()
    if not count:
        return df.select(*columns)
    again = might_hold(key_filter(repeated.select("_h"), count), count, F.col("_h"))
    last = F.max_by(F.struct(*columns), F.struct(*order)).alias("_last")
    few = keyed.filter(again).groupBy(*names).agg(last).select("_last.*")
    return keyed.filter(~again).select(*columns).unionByName(few)
