"""Plant feeds between landing and core: typed columns, decoding, wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.feeds import (
    BLEND_LAB_CONTAINERS,
    LAB_MEASURES,
    PREDICTED_SPEC_MIN,
    RECIPE_MEASURES,
    TAG_PAIRS,
    FeedSpec,
    tag_columns,
)
from feedmill.functions.text import typed_null
from feedmill.functions.typing import (
    NUMBER,
    as_typed,
    stamp_clock,
    stamp_day,
    to_clock,
    to_number,
    to_stamp,
)
from feedmill.operators.lookup import decode, unmapped
from feedmill.operators.replace import number_between
from feedmill.operators.reshape import (
    unpivot_measures,
    unpivot_pairs,
    unpivot_two_keys,
    unpivot_with_companion,
)
from feedmill.operators.summary import latest_per_key
from feedmill.tables import table

CONTAINER_LOOKUP = [("Ref_Location", "Ref_Location"), ("Tank", "Container_Desc")]
MATERIAL_LOOKUP = [("Ref_Location", "Ref_Location"), ("Material", "Material")]


def typed_rows(stage: DataFrame, spec: FeedSpec) -> DataFrame:
    """Landed text as the columns and types of the feed's own core table."""
    kinds = table(spec.table).columns

    def cell(c: str) -> Column:
        typed = to_clock(F.col(c)) if c in spec.times else as_typed(F.col(c), kinds[c])
        return typed.alias(c)

    return stage.select(*[cell(c) for c in kinds])


def _typed(stage: DataFrame, kinds: dict[str, str], times: Sequence[str] = ()) -> DataFrame:
    """Type the columns named in ``kinds``, pass the others on."""

    def cell(c: str) -> Column:
        if c in times:
            return to_clock(F.col(c)).alias(c)
        return as_typed(F.col(c), kinds[c]).alias(c) if c in kinds else F.col(c)

    return stage.select(*[cell(c) for c in stage.columns])


def blend_lab_rows(stage: DataFrame) -> DataFrame:
    """Sixteen measures per blend sample as lab results, without spec limits.

    Sample columns are typed while there is one row per sample.
    """
    kinds = table("lab").columns
    ids = [c for c in kinds if c in set(stage.columns)]
    samples = _typed(stage, {c: kinds[c] for c in ids}, [c for c in ids if c.endswith("_Time")])
    rows = unpivot_measures(samples, ids, LAB_MEASURES).withColumns(
        {"Result_MinSpec": typed_null(), "Result_MaxSpec": typed_null()}
    )
    return rows.select(*kinds)


def blend_lab_scope() -> Column:
    """The core rows a blend-lab load replaces."""
    return number_between(F.col("Container_ID"), *BLEND_LAB_CONTAINERS)


def blend_pred_rows(stage: DataFrame) -> DataFrame:
    """Sixteen predictions per blend; two of them have a minimum of their own."""
    numbers = {c: NUMBER for c in (*LAB_MEASURES, *PREDICTED_SPEC_MIN.values())}
    rows = unpivot_with_companion(
        _typed(stage, numbers), ["Ref_Location", "Blend_ID"], LAB_MEASURES, PREDICTED_SPEC_MIN,
        companion_type=NUMBER,
    ).withColumn("Spec_Max", typed_null(NUMBER))
    return rows.select(*table("blend_pred").columns)


def blend_recipe_rows(stage: DataFrame) -> DataFrame:
    """Ten component volumes per blend, keyed by material and container."""
    ids = ["Ref_Location", "Blend_ID", "Blend_Rep", "Blend_PlanAct"]
    volumes = _typed(stage, {c: NUMBER for c in RECIPE_MEASURES})
    rows = unpivot_two_keys(volumes, ids, RECIPE_MEASURES)
    return rows.select(*table("blend_recipe").columns)


def inventory_rows(stage: DataFrame, container: DataFrame, material: DataFrame) -> DataFrame:
    """Tank readings with container and material ids in place of names.

    Readings whose tank or material the dictionaries lack are dropped;
    :func:`inventory_unmapped` reports them.
    """
    rows = decode(stage, container, CONTAINER_LOOKUP, ["Container_ID"], prefix="_c")
    rows = decode(rows, material, MATERIAL_LOOKUP, ["Material_ID"], prefix="_m")
    no_number = typed_null(NUMBER)
    return rows.select(
        "Ref_Location",
        "Container_ID",
        stamp_day(F.col("Inv_Timestamp")).alias("Inventory_Date"),
        stamp_clock(F.col("Inv_Timestamp")).alias("Inventory_Time"),
        "Material_ID",
        to_number(F.col("Gross_Qty")).alias("Gross_Qty"),
        to_number(F.col("Net_Qty")).alias("Net_Qty"),
        to_number(F.col("Temp")).alias("Temperature"),
        F.col("Temp_UOM").alias("Temperature_UOM"),
        "Gauge",
        no_number.alias("Gauge_Ft"),
        no_number.alias("Gauge_In"),
        to_number(F.col("BSW")).alias("BSW"),
        no_number.alias("BSW_Ft"),
        no_number.alias("BSW_In"),
        to_number(F.col("Water")).alias("Water"),
        "Units",
    )


def inventory_unmapped(stage: DataFrame, container: DataFrame, material: DataFrame) -> DataFrame:
    lookups = [
        ("container", container, CONTAINER_LOOKUP),
        ("material", material, MATERIAL_LOOKUP),
    ]
    return unmapped(stage, lookups)


def sensor_readings(stage: DataFrame, arrival: Sequence[str] = ()) -> DataFrame:
    """Wide sensor rows as one reading per location, tag and time.

    Our choice: pairs without a tag are unused, and where a reading comes twice
    the one that arrived last counts. Without ``arrival`` columns the readings
    are taken to be unique.
    """
    pairs = [tag_columns(i) for i in range(1, TAG_PAIRS + 1)]
    stamped = stage.withColumn("Trans_Timestamp", to_stamp(F.col("Trans_Timestamp")))
    ids = ["Ref_Location", "Trans_Timestamp", *arrival]
    rows = unpivot_pairs(stamped, ids, pairs).select(
        "Ref_Location", "Tag_ID", "Trans_Timestamp", "Tag_Value", *arrival
    )
    return latest_per_key(rows, table("sensor").keys, arrival) if arrival else rows
