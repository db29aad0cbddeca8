"""Core tables: typed columns, audit columns and how each table is sliced.

The column lists follow the positional insert lists of the load jobs. The types
are our choice: dates are DATE, times text ``HH:mm:ss``, quantities and prices
DECIMAL(18,4), ids and descriptions text. Columns whose blanks are kept as
blanks stay text.

A slice is the unit an upsert rewrites. Tables whose match key holds a date are
sliced by it, so a daily file rewrites its own days and nothing else; the other
upsert targets are sliced by a hash of the match key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.feeds import AUDIT, FEEDS, LAB_STEP_COLUMNS, PRICE_KEYS, UPDATED, FeedSpec
from feedmill.functions.text import match_form

NUMBER = "decimal(18,4)"
WHOLE = "all"


@dataclass(frozen=True)
class CoreTable:
    name: str
    columns: dict[str, str]
    audit: tuple[str, ...] = AUDIT
    keys: tuple[str, ...] = ()
    slice_date: str | None = None

    @property
    def data_columns(self) -> list[str]:
        return list(self.columns)

    @property
    def schema(self) -> T.StructType:
        fields = {**self.columns, **{a: "timestamp" for a in self.audit}}
        return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields.items()])

    @property
    def slices_by_hash(self) -> bool:
        return bool(self.keys) and self.slice_date is None

    def slice_of(self, buckets: int) -> Column:
        if self.slice_date:
            return F.coalesce(F.col(self.slice_date).cast("date").cast("string"), F.lit("none"))
        if self.slices_by_hash:
            parts = [match_form(F.col(k)) for k in self.keys]
            return F.format_string("%05d", F.pmod(F.xxhash64(*parts), F.lit(buckets)))
        return F.lit(WHOLE)


_TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    NUMBER: T.DecimalType(18, 4),
    "decimal(38,6)": T.DecimalType(38, 6),
}


def _typed(names, numbers=(), dates=()) -> dict[str, str]:
    kind = {**{n: NUMBER for n in numbers}, **{d: "date" for d in dates}}
    return {n: kind.get(n, "string") for n in names}


def _plain(spec: FeedSpec, slice_date: str | None = None) -> CoreTable:
    """A core table with the landed columns in landed order."""
    columns = _typed(spec.columns, spec.numbers, spec.dates)
    return CoreTable(spec.table, columns, spec.audit, spec.keys, slice_date)


_SLICE_DATES = {
    "cost": "Cost_Date",
    "movements": "Movement_Start_Date",
    "safety": "Safety_Date",
    "unit": "Unit_Date",
}

_RESHAPED = {"blend_lab", "blend_pred", "blend_recipe", "inventory", "sensor"}

# Column order of the core tables that differ from their landed file.
PRICE_COLUMNS = PRICE_KEYS + (
    "Price_Location", "Price_Description", "Price_Open", "Price_Low", "Price_High", "Price_Avg",
    "Price_Close", "Price_Index", "Price_Volume", "Price_UOM", "Price_Country",
    "Price_DeliveryType", "Price_Currency",
)
PRICE_NUMBERS = (
    "Price_Open", "Price_Low", "Price_High", "Price_Avg", "Price_Close", "Price_Index",
    "Price_Volume",
)
INVENTORY_COLUMNS = (
    "Ref_Location", "Container_ID", "Inventory_Date", "Inventory_Time", "Material_ID",
    "Gross_Qty", "Net_Qty", "Temperature", "Temperature_UOM", "Gauge", "Gauge_Ft", "Gauge_In",
    "BSW", "BSW_Ft", "BSW_In", "Water", "Units",
)
INVENTORY_NUMBERS = (
    "Gross_Qty", "Net_Qty", "Temperature", "Gauge_Ft", "Gauge_In", "BSW", "BSW_Ft", "BSW_In",
    "Water",
)
LAB_COLUMNS = (
    "Ref_Location", "Sample_ID", "Component_ID", "Test_Rep", "Sample_Point", "Material_ID",
    "Container_ID", *LAB_STEP_COLUMNS, "Status", "Result_Value", "Result_MinSpec",
    "Result_MaxSpec",
)
BLEND_PRED_COLUMNS = (
    "Ref_Location", "Blend_ID", "Component_ID", "Spec_Min", "Spec_Max", "Predicted_Value",
)
BLEND_RECIPE_COLUMNS = (
    "Ref_Location", "Blend_ID", "Blend_Rep", "Blend_PlanAct", "Material_Id", "Container_Id",
    "Blend_Component_Volume",
)


def _tables() -> dict[str, CoreTable]:
    tables = [
        _plain(spec, _SLICE_DATES.get(spec.name))
        for spec in FEEDS.values()
        if spec.name not in _RESHAPED and spec.table != "price"
    ]
    tables += [
        CoreTable(
            "inventory",
            _typed(INVENTORY_COLUMNS, INVENTORY_NUMBERS, ("Inventory_Date",)),
            keys=FEEDS["inventory"].keys,
            slice_date="Inventory_Date",
        ),
        CoreTable(
            "price",
            _typed(PRICE_COLUMNS, PRICE_NUMBERS, ("Price_Date",)),
            keys=PRICE_KEYS,
            slice_date="Price_Date",
        ),
        CoreTable(
            "blend_pred",
            _typed(BLEND_PRED_COLUMNS, ("Spec_Min", "Spec_Max", "Predicted_Value")),
        ),
        CoreTable("blend_recipe", _typed(BLEND_RECIPE_COLUMNS, ("Blend_Component_Volume",))),
        CoreTable(
            "sensor",
            {
                "Ref_Location": "string",
                "Tag_ID": "string",
                "Trans_Timestamp": "timestamp_ntz",
                "Tag_Value": "string",
            },
            keys=FEEDS["sensor"].keys,
            slice_date="Trans_Timestamp",
        ),
        CoreTable(
            "sensor_daily",
            {
                "Ref_Location": "string",
                "Tag_ID": "string",
                "Reading_Date": "date",
                "Readings": "bigint",
                "Numbers": "bigint",
                "Number_Sum": "decimal(38,6)",
                "Min_Value": "double",
                "Max_Value": "double",
                "Avg_Value": "double",
                "Last_Stamp": "timestamp_ntz",
                "Last_Value": "double",
            },
            audit=(UPDATED,),
            keys=("Ref_Location", "Tag_ID", "Reading_Date"),
            slice_date="Reading_Date",
        ),
    ]
    return {t.name: t for t in tables}


TABLES = _tables()


def table(name: str) -> CoreTable:
    return TABLES[name]
