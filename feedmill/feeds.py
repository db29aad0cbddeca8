"""The 32 feeds as data: file layout, clean-up, write mode and target table.

A layout line is ``name width [required]``. Cells are bound to columns by
position, never by header name, and every landed column is text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

RELOAD, UPSERT, REPLACE, SENSOR = "reload", "upsert", "replace", "sensor"

CREATED, UPDATED = "Create_Dttm", "Last_Update_Dttm"
AUDIT = (CREATED, UPDATED)

TAG_PAIRS = 50


@dataclass(frozen=True)
class Column:
    name: str
    width: int
    required: bool = False


@dataclass(frozen=True)
class FeedSpec:
    """One load job, declared.

    ``keep_blank`` lists nullable columns whose blanks stay blanks: every other
    nullable column has blanks turned into NULL. ``numbers`` are landed columns
    that must read as numbers, ``dates`` and ``times`` as dates and times.
    """

    name: str
    table: str
    mask: str
    layout: tuple[Column, ...]
    folder: str = ""
    skip: int = 1
    sep: str = ","
    write: str = RELOAD
    keys: tuple[str, ...] = ()
    updates: tuple[str, ...] = ()
    keep_blank: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    times: tuple[str, ...] = ()
    audit: tuple[str, ...] = AUDIT
    needs: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [c.name for c in self.layout]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.layout if c.required]

    @property
    def blank_to_null(self) -> list[str]:
        return [c.name for c in self.layout if not c.required and c.name not in self.keep_blank]

    @property
    def widths(self) -> dict[str, int]:
        return {c.name: c.width for c in self.layout}

    @property
    def nullable_keys(self) -> list[str]:
        required = set(self.required)
        return [k for k in self.keys if k not in required]


def layout(text: str) -> tuple[Column, ...]:
    columns = []
    for line in text.strip().splitlines():
        name, width, *flag = line.split()
        columns.append(Column(name, int(width), flag == ["required"]))
    return tuple(columns)


# --------------------------------------------------------------------------
# Wide measure columns and the literal keys their names encode.
# --------------------------------------------------------------------------

LAB_MEASURES = {
    "RON_76": 76, "MON_67": 67, "TVLF_94": 94, "DI_32": 32,
    "BENZ_20": 20, "SULF_85": 85, "AROM_19": 19, "OLEF_95": 95,
    "E200_34": 34, "E300_35": 35, "D8610_1": 1, "D8650_2": 2,
    "D8690_3": 3, "API_62": 62, "RVP_80": 80, "RM2_78": 78,
}

# Predicted measures share the lab keys; two carry their own minimum spec.
PREDICTED_SPEC_MIN = {"RVP_80": "RVP_MinSpec", "RM2_78": "RM2_MinSpec"}

RECIPE_MEASURES = {
    "LCC_42_49": (42, 49), "WREF_44_9": (44, 9), "HREF_48_48": (48, 48),
    "LREF_45_23": (45, 23), "LOALK_41_31": (41, 31), "HBAT_85_20": (85, 20),
    "TOL_86_21": (86, 21), "OLE_70_22": (70, 22), "BUT_46_78": (46, 78),
    "TRANS_87_108": (87, 108),
}

# Containers whose lab rows the blend-lab load replaces (inclusive).
BLEND_LAB_CONTAINERS = (97, 101)

# --------------------------------------------------------------------------
# Layout fragments that several feeds share.
# --------------------------------------------------------------------------

LAB_STEPS = ("Sample", "Receipt", "Login", "Complete", "Authorize")


def _lab_steps() -> tuple[Column, ...]:
    parts = (("Date", 10), ("Time", 10), ("By", 45))
    return tuple(Column(f"{step}_{part}", width) for step in LAB_STEPS for part, width in parts)


def _measures(names, width: int = 20) -> tuple[Column, ...]:
    return tuple(Column(name, width) for name in names)


def _predicted() -> tuple[Column, ...]:
    names = []
    for measure in LAB_MEASURES:
        names.append(measure)
        if measure in PREDICTED_SPEC_MIN:
            names.append(PREDICTED_SPEC_MIN[measure])
    return _measures(names)


def tag_columns(i: int) -> tuple[str, str]:
    return f"Tag{i}_ID", f"Tag{i}_Value"


def _tag_pairs() -> tuple[Column, ...]:
    out = []
    for i in range(1, TAG_PAIRS + 1):
        tag, value = tag_columns(i)
        out += [Column(tag, 100), Column(value, 20)]
    return tuple(out)


def _opis(with_close: bool) -> tuple[Column, ...]:
    head = layout("""
        Price_Col1        1
        Price_Description 50 required
        Price_Date        10 required
        Price_Low         20
        Price_High        20
        Price_Avg         20
    """)
    close = layout("Price_Close 20") if with_close else ()
    tail = layout("""
        Price_Country      2
        Price_UOM          3
        Price_DeliveryType 1
        Price_Freq         1
    """)
    return head + close + tail


LAB_STEP_COLUMNS = tuple(c.name for c in _lab_steps())
LAB_STEP_DATES = tuple(c for c in LAB_STEP_COLUMNS if c.endswith("_Date"))
LAB_STEP_TIMES = tuple(c for c in LAB_STEP_COLUMNS if c.endswith("_Time"))

PRICE_KEYS = ("Price_Source", "Price_Type", "Price_Date", "Price_Time", "Price_Code", "Price_Freq")
PRICE_UPDATES = ("Price_Low", "Price_High", "Price_Avg", "Price_Close", "Price_UOM")

# --------------------------------------------------------------------------
# The feeds, with the layouts, masks, keys and update lists that
# the input files and core tables prescribe.
# --------------------------------------------------------------------------

_FEEDS = [
    FeedSpec(
        name="blend_lab",
        table="lab",
        mask="Blend_Lab.csv",
        layout=layout("""
            Ref_Location  50 required
            Sample_ID     20 required
            Test_Rep      20 required
            Sample_Point 100 required
            Material_ID   20
            Container_ID  20
        """) + _lab_steps() + layout("Status 20") + _measures(LAB_MEASURES),
        write=REPLACE,
        keys=("Ref_Location", "Sample_ID", "Component_ID", "Test_Rep", "Sample_Point"),
        dates=LAB_STEP_DATES,
        times=LAB_STEP_TIMES,
    ),
    FeedSpec(
        name="blend",
        table="blend",
        mask="Blend.csv",
        layout=layout("""
            Ref_Location 50 required
            Blend_ID     20 required
            Blend_Spec   20
            Blend_Date   10
            Blend_Time   10
            Material_ID  20
            Container_ID 20
        """),
        write=UPSERT,
        keys=("Ref_Location", "Blend_ID"),
        updates=("Blend_Spec", "Blend_Date", "Blend_Time", "Material_ID", "Container_ID"),
        dates=("Blend_Date",),
        times=("Blend_Time",),
    ),
    FeedSpec(
        name="blend_pred",
        table="blend_pred",
        mask="Blend_Pred.csv",
        layout=layout("""
            Ref_Location 50 required
            Blend_ID     20 required
        """) + _predicted(),
        numbers=tuple(c.name for c in _predicted()),
    ),
    FeedSpec(
        name="blend_recipe",
        table="blend_recipe",
        mask="Blend_Recipe.csv",
        layout=layout("""
            Ref_Location  50 required
            Blend_ID      20 required
            Blend_Rep     10 required
            Blend_PlanAct 10 required
        """) + _measures(RECIPE_MEASURES),
        numbers=tuple(RECIPE_MEASURES),
    ),
    FeedSpec(
        name="caldate",
        table="caldate",
        mask="CalDate.csv",
        layout=layout("""
            Cal_Date  10 required
            Cal_Month 20
            Cal_Year  20
        """),
        dates=("Cal_Date",),
        audit=(),
    ),
    FeedSpec(
        name="container",
        table="container",
        mask="Container.csv",
        layout=layout("""
            Ref_Location    50 required
            Container_ID    20 required
            Container_Type  20
            Container_Desc 100
            Min_Op_Qty      20
            Max_Op_Qty      20
            Min_Op_Hgt      20
            Max_Op_Hgt      20
            Units           20
        """),
        numbers=("Min_Op_Qty", "Max_Op_Qty", "Min_Op_Hgt", "Max_Op_Hgt"),
    ),
    FeedSpec(
        name="costforensics",
        table="costforensics",
        mask="CostForensics.csv",
        layout=layout("""
            Ref_Location  50 required
            CF_Type       10 required
            CF_Unit       20 required
            CF_ActPlan    10 required
            CF_Category1 100 required
            CF_Category2 100 required
            CF_Category3 100 required
            CF_Date       10
            CF_Cost       20
        """),
        keep_blank=("CF_Date",),
        numbers=("CF_Cost",),
    ),
    FeedSpec(
        name="cost",
        table="cost",
        mask="Cost.csv",
        layout=layout("""
            Ref_Location      50 required
            Cost_PlanAct      10 required
            Cost_FixedVar     10 required
            Cost_Date         10 required
            Cost_Time          8 required
            Cost_Description 100 required
            Cost_Value        15
        """),
        write=UPSERT,
        keys=(
            "Ref_Location", "Cost_PlanAct", "Cost_FixedVar",
            "Cost_Date", "Cost_Time", "Cost_Description",
        ),
        updates=("Cost_Value",),
        dates=("Cost_Date",),
        times=("Cost_Time",),
        numbers=("Cost_Value",),
    ),
    FeedSpec(
        name="inventory_dcd",
        table="inventory_dcd",
        mask="Inventory_Dcd.csv",
        layout=layout("""
            Ref_Location  50 required
            Material_ID   20 required
            Material     100 required
        """),
    ),
    FeedSpec(
        name="inventory",
        table="inventory",
        mask="Inventory.csv",
        layout=layout("""
            Ref_Location   50 required
            Inv_Timestamp  20 required
            Tank           20 required
            Material      100
            Gross_Qty      20
            BSW            20
            Water          20
            Net_Qty        20
            Units          20
            Gauge          20
            Temp           20
            Temp_UOM        1
        """),
        write=UPSERT,
        keys=("Ref_Location", "Inventory_Date", "Inventory_Time", "Container_ID"),
        updates=(
            "Material_ID", "Gross_Qty", "Net_Qty", "Temperature", "Temperature_UOM",
            "Gauge", "Gauge_Ft", "Gauge_In", "BSW", "BSW_Ft", "BSW_In", "Water", "Units",
        ),
        keep_blank=("Gauge",),
        numbers=("Gross_Qty", "BSW", "Water", "Net_Qty", "Temp"),
        needs=("container", "inventory_dcd"),
    ),
    FeedSpec(
        name="lab_comp_group",
        table="lab_comp_group",
        mask="Lab_Comp_Group.csv",
        layout=layout("""
            Ref_Location     50 required
            Component_Group 100 required
            Component_ID     20 required
        """),
    ),
    FeedSpec(
        name="lab_comp",
        table="lab_comp",
        mask="Lab_Comp.csv",
        layout=layout("""
            Ref_Location     50 required
            Component_ID     20 required
            Component_Desc  100
            Component_Units  20
        """),
    ),
    FeedSpec(
        name="lab",
        table="lab",
        mask="Lab.csv",
        layout=layout("""
            Ref_Location  50 required
            Sample_ID     20 required
            Component_ID  20 required
            Test_Rep      20 required
            Sample_Point 100 required
            Material_ID   20
            Container_ID  20
        """) + _lab_steps() + layout("""
            Status          20
            Result_Value   100
            Result_MinSpec 100
            Result_MaxSpec 100
        """),
        write=UPSERT,
        keys=("Ref_Location", "Sample_ID", "Component_ID", "Test_Rep", "Sample_Point"),
        updates=("Material_ID", "Container_ID") + LAB_STEP_COLUMNS
        + ("Status", "Result_Value", "Result_MinSpec", "Result_MaxSpec"),
        dates=LAB_STEP_DATES,
        times=LAB_STEP_TIMES,
    ),
    FeedSpec(
        name="liftings",
        table="liftings",
        mask="liftings*.csv",
        layout=layout("""
            Ref_Location           50 required
            BOL_Number             20 required
            BOL_Line_Number        20 required
            BOL_Version            20 required
            BOL_Product            50
            Material_ID            20
            BOL_Last_Modified_Date 10
            BOL_Last_Modified_Time  8
            Station                10
            Order_ID               10
            PO_Number              20
            Contract_ID            20
            Start_Date             10
            Start_Time              8
            Stop_Date              10
            Stop_Time               8
            Customer               50
            Carrier                50
            Destination            50
            Driver                 50
            Container_ID           20
            Transport_ID           20
            Gross_Volume           20
            Net_Volume             20
            Volume_UOM             10
        """),
        write=UPSERT,
        keys=("Ref_Location", "BOL_Number", "BOL_Line_Number", "BOL_Version", "BOL_Product"),
        updates=(
            "Material_ID", "BOL_Last_Modified_Date", "BOL_Last_Modified_Time", "Station",
            "Order_ID", "PO_Number", "Contract_ID", "Start_Date", "Start_Time", "Stop_Date",
            "Stop_Time", "Customer", "Carrier", "Destination", "Driver", "Container_ID",
            "Transport_ID", "Gross_Volume", "Net_Volume", "Volume_UOM",
        ),
        keep_blank=("BOL_Product",),
        dates=("BOL_Last_Modified_Date", "Start_Date", "Stop_Date"),
        times=("BOL_Last_Modified_Time", "Start_Time", "Stop_Time"),
        numbers=("Gross_Volume", "Net_Volume"),
    ),
    FeedSpec(
        name="marketprice",
        table="marketprice",
        mask="MPrice.csv",
        layout=layout("""
            MPrice_Date   10 required
            MPrice_Symbol 10 required
            MPrice_Type   10 required
            MPrice_Units  10
            MPrice        20
        """),
        dates=("MPrice_Date",),
        numbers=("MPrice",),
    ),
    FeedSpec(
        name="material_hier_group",
        table="material_hier_group",
        mask="material_hier_group.csv",
        layout=layout("""
            Material_Hier_Group 50 required
            Ref_Location        50 required
        """),
    ),
    FeedSpec(
        name="material_hier",
        table="material_hier",
        mask="material_hier.csv",
        layout=layout("""
            Ref_Location     50 required
            Material_Cat1    50 required
            Material_Cat2    50 required
            Material_Cat3    50 required
            Material_Cat4    50 required
            Material_Cat5    50 required
            Material_Cat6    50 required
            Material_ID      20 required
            Material_Percent 20
        """),
        numbers=("Material_Percent",),
    ),
    FeedSpec(
        name="material",
        table="material",
        mask="material.csv",
        layout=layout("""
            Ref_Location   50 required
            Material_ID    20 required
            Material_Code  20
            Material_Desc 100
            Price_Code     50
        """),
    ),
    FeedSpec(
        name="movements",
        table="movements",
        mask="movements.csv",
        layout=layout("""
            Ref_Location         50 required
            Movement_Type        20 required
            Movement_Start_Date  10 required
            Movement_Start_Time  10 required
            Movement_Source_ID   20 required
            Movement_Dest_ID     20 required
            Movement_End_Date    10 required
            Movement_End_Time    10 required
            Material_ID          20
            Volume               20
            Weight               20
            Ticket_Number        20
            Comments            500
        """),
        write=UPSERT,
        keys=(
            "Ref_Location", "Movement_Type", "Movement_Start_Date", "Movement_Start_Time",
            "Movement_Source_ID", "Movement_Dest_ID", "Movement_End_Date", "Movement_End_Time",
        ),
        updates=("Material_ID", "Volume", "Weight", "Ticket_Number", "Comments"),
        dates=("Movement_Start_Date", "Movement_End_Date"),
        times=("Movement_Start_Time", "Movement_End_Time"),
        numbers=("Volume", "Weight"),
    ),
    FeedSpec(
        name="optthruput_weights",
        table="optthruput_weights",
        mask="OptimalThroughPut.csv",
        layout=layout("""
            Ref_Location               50 required
            Material                   50 required
            PriceHigh_Today_USD_WT     15
            PriceHigh_Yesterday_USD_WT 15
            Plan_Today_USD_WT          15
            Actual_Today_USD_WT        15
            ActualDelta_Percent_WT     15
            Intercept                  15
        """),
        numbers=(
            "PriceHigh_Today_USD_WT", "PriceHigh_Yesterday_USD_WT", "Plan_Today_USD_WT",
            "Actual_Today_USD_WT", "ActualDelta_Percent_WT", "Intercept",
        ),
    ),
    FeedSpec(
        name="price_crack",
        table="price",
        mask="Crack.csv",
        skip=2,
        layout=layout("""
            WTI_Date       10 required
            WTI_Price      20
            Gasoline_Date  10 required
            Gasoline_Price 20
            Diesel_Date    10 required
            Diesel_Price   20
        """),
        write=UPSERT,
        keys=PRICE_KEYS,
        updates=PRICE_UPDATES,
        numbers=("WTI_Price", "Gasoline_Price", "Diesel_Price"),
    ),
    FeedSpec(
        name="price_futures",
        table="price",
        mask="futuresdata.csv",
        folder="pricing/futures",
        layout=layout("""
            Price_Type         2 required
            Price_FutureMonth  1 required
            Price_FutureYear   2 required
            Price_Date        10 required
            Price_Open        20
            Price_High        20
            Price_Low         20
            Price_Close       20
            Price_Volume      10
            Price_OpenInt     10
        """),
        write=UPSERT,
        keys=PRICE_KEYS,
        updates=PRICE_UPDATES,
        dates=("Price_Date",),
        numbers=("Price_Open", "Price_High", "Price_Low", "Price_Close", "Price_Volume"),
    ),
    FeedSpec(
        name="price_opisfeed",
        table="price",
        mask="opisfeedstocksdatafiles.csv",
        folder="pricing/opis",
        skip=0,
        layout=_opis(with_close=False),
        write=UPSERT,
        keys=PRICE_KEYS,
        updates=PRICE_UPDATES,
        keep_blank=("Price_Col1",),
        dates=("Price_Date",),
        numbers=("Price_Low", "Price_High", "Price_Avg"),
    ),
    FeedSpec(
        name="price_opisspot",
        table="price",
        mask="opisspotsdatafiles.csv",
        folder="pricing/opis",
        skip=0,
        layout=_opis(with_close=True),
        write=UPSERT,
        keys=PRICE_KEYS,
        updates=PRICE_UPDATES,
        keep_blank=("Price_Col1", "Price_Close"),
        dates=("Price_Date",),
        numbers=("Price_Low", "Price_High", "Price_Avg"),
    ),
    FeedSpec(
        name="price_platts_dcd",
        table="price_platts_dcd",
        mask="*.csv",
        folder="pricing/platts",
        skip=2,
        layout=layout("""
            Price_MDC            2 required
            Price_Code           8 required
            Price_Bates          5
            Price_Precision      1
            Price_Freq           5
            Price_Currency       3
            Price_UOM            3
            Price_Conv          10
            Price_ConvArith      1
            Price_ToUOM          3
            Price_EarliestDate  10
            Price_LatestDate    10
            Price_Act            1
            Price_Description  200
            Price_Location     200
            Price_Group        200
        """),
        audit=(),
    ),
    FeedSpec(
        name="price_platts",
        table="price",
        mask="*.ftp",
        folder="pricing/platts",
        skip=2,
        sep=" ",
        layout=layout("""
            Price_Col1      1
            Price_Code      8 required
            Price_DateTime 14 required
            Price          20
        """),
        write=UPSERT,
        keys=PRICE_KEYS,
        updates=PRICE_UPDATES,
        keep_blank=("Price_Col1",),
        numbers=("Price",),
        needs=("price_platts_dcd",),
    ),
    FeedSpec(
        name="safety",
        table="safety",
        mask="safety.csv",
        layout=layout("""
            Ref_Location   50 required
            Safety_Date    10 required
            Safety_Time    10 required
            Safety_ActPlan 20 required
            Safety_Metric 100 required
            Safety_Value   20
        """),
        write=UPSERT,
        keys=("Ref_Location", "Safety_Date", "Safety_Time", "Safety_ActPlan", "Safety_Metric"),
        updates=("Safety_Value",),
        dates=("Safety_Date",),
        times=("Safety_Time",),
        numbers=("Safety_Value",),
    ),
    FeedSpec(
        name="sensor_descunits",
        table="sensor_descunits",
        mask="sensor_descunits.csv",
        skip=5,
        layout=layout("""
            Ref_Location  50 required
            Tag_ID       100 required
            Tag_Desc     100
            Tag_Units    100
        """),
        audit=(UPDATED,),
    ),
    FeedSpec(
        name="sensor",
        table="sensor",
        mask="*.csv",
        folder="Tags",
        skip=4,
        layout=layout("""
            Trans_Timestamp 20 required
            Ref_Location    50 required
        """) + _tag_pairs(),
        write=SENSOR,
        keys=("Ref_Location", "Tag_ID", "Trans_Timestamp"),
        updates=("Tag_Value",),
        keep_blank=tuple(c.name for c in _tag_pairs()),
    ),
    FeedSpec(
        name="sensor_loadparams",
        table="sensor_loadparams",
        mask="sensor_loadparams.csv",
        layout=layout("""
            Extract_Group 20
            Ref_Location  50
        """) + tuple(Column(tag_columns(i)[0], 100) for i in range(1, TAG_PAIRS + 1)),
        keep_blank=("Extract_Group", "Ref_Location"),
        audit=(),
    ),
    FeedSpec(
        name="tag_container_xref",
        table="tag_container_xref",
        mask="Tag_Container_XREF.csv",
        layout=layout("""
            Ref_Location  50 required
            Container_ID  20 required
            Tag_ID       100
        """),
    ),
    FeedSpec(
        name="unit",
        table="unit",
        mask="unit.csv",
        layout=layout("""
            Ref_Location   50 required
            Unit_Date      10 required
            Unit_Time      10 required
            Unit_Name      30 required
            Unit_RateType  10 required
            Unit_RateUOM   10
            Unit_RateValue 20
        """),
        write=UPSERT,
        keys=("Ref_Location", "Unit_Date", "Unit_Time", "Unit_Name", "Unit_RateType"),
        updates=("Unit_RateUOM", "Unit_RateValue"),
        dates=("Unit_Date",),
        times=("Unit_Time",),
        numbers=("Unit_RateValue",),
    ),
]

FEEDS: dict[str, FeedSpec] = {spec.name: spec for spec in _FEEDS}


def feed(name: str) -> FeedSpec:
    return FEEDS[name]
