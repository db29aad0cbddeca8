"""Inventory decoding, blend and sensor reshapes with the feeds' own columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedmill.catalogue.base import (
    LOAD_TS,
    OLD_TS,
    Query,
    blank_sql,
    derive,
    merge_sql,
    plain,
    same_sql,
    shown,
)
from feedmill.feeds import LAB_MEASURES, LAB_STEP_COLUMNS, RECIPE_MEASURES, feed
from feedmill.operators.normalise import normalise, with_audit
from feedmill.operators.replace import replace_where
from feedmill.operators.summary import average, daily_states, latest_per_key
from feedmill.operators.upsert import merge_upsert
from feedmill.plans import loader, plant
from feedmill.tables import INVENTORY_COLUMNS, LAB_COLUMNS

# Events stand for tank readings: some tanks and materials are not in the
# dictionaries, and spellings differ in case and trailing blanks.
READINGS = """
    SELECT 'R' || cast(user_id % 5 AS string) AS Ref_Location,
           substring(cast(ts AS string), 1, 19) AS Inv_Timestamp,
           'nation_' || cast(user_id AS string) AS Tank,
           CASE WHEN event_type = 'error' THEN ' ' ELSE event_type END AS Material,
           cast(cast(value AS decimal(18,4)) AS string) AS Gross_Qty,
           '' AS BSW, '0' AS Water,
           CASE WHEN event_type = 'view' THEN '' ELSE cast(cast(value AS decimal(18,4)) AS string) END
               AS Net_Qty,
           'BBL' AS Units, '' AS Gauge, cast(user_id AS string) AS Temp, 'F' AS Temp_UOM
    FROM {events}
"""
CONTAINERS = """
    SELECT 'R' || cast(n_regionkey AS string) AS Ref_Location,
           cast(n_nationkey AS string) AS Container_ID, n_name AS Container_Desc
    FROM {nation}
"""
MATERIALS = """
    SELECT DISTINCT 'R' || cast(user_id % 5 AS string) AS Ref_Location,
           'M-' || event_type AS Material_ID, upper(event_type) || '  ' AS Material
    FROM {events} WHERE event_type <> 'signup'
"""
INVENTORY_CORE = """
    SELECT 'r' || cast(user_id % 5 AS string) AS Ref_Location,
           cast(user_id AS string) AS Container_ID,
           substring(cast(ts AS string), 1, 10) AS Inventory_Date,
           substring(cast(ts AS string), 12, 8) AS Inventory_Time,
           'M-old' AS Material_ID, '1.0000' AS Gross_Qty, '2.0000' AS Net_Qty
    FROM {events} WHERE event_type <> 'click'
"""


def _readings(spark, sf_dir):
    return normalise(derive(spark, sf_dir, READINGS), feed("inventory").blank_to_null)


def _inventory(spark, sf_dir):
    return plant.inventory_rows(
        _readings(spark, sf_dir),
        derive(spark, sf_dir, CONTAINERS),
        derive(spark, sf_dir, MATERIALS),
    )


def inventory_decode(spark, sf_dir):
    return shown(_inventory(spark, sf_dir))


def inventory_unmapped(spark, sf_dir):
    out = plant.inventory_unmapped(
        _readings(spark, sf_dir),
        derive(spark, sf_dir, CONTAINERS),
        derive(spark, sf_dir, MATERIALS),
    )
    return out.select("Ref_Location", "Inv_Timestamp", "Tank", "Material", "Gross_Qty", "missing")


def feed_inventory(spark, sf_dir):
    stage = _inventory(spark, sf_dir)
    kinds = {f.name: f.dataType.simpleString() for f in stage.schema.fields}
    old = derive(spark, sf_dir, INVENTORY_CORE)
    core = old.selectExpr(
        *[
            f"cast({c if c in old.columns else 'NULL'} AS {kinds[c]}) AS {c}"
            for c in INVENTORY_COLUMNS
        ]
    )
    spec = feed("inventory")
    return shown(
        merge_upsert(
            with_audit(core, OLD_TS), stage,
            keys=spec.keys, updates=spec.updates, load_ts=LOAD_TS, nullable_keys=(),
        )
    )


READINGS_SQL = f"""
    SELECT Ref_Location, Inv_Timestamp, Tank, Gauge,
           {", ".join(f"{blank_sql(c)} AS {c}" for c in feed("inventory").blank_to_null)}
    FROM ({plain(READINGS)}) r
"""
INVENTORY_SQL = f"""
    SELECT s.Ref_Location, c.Container_ID,
           substr(s.Inv_Timestamp, 1, 10) AS Inventory_Date,
           substr(s.Inv_Timestamp, 12, 8) AS Inventory_Time,
           m.Material_ID,
           cast(cast(s.Gross_Qty AS decimal(18,4)) AS varchar) AS Gross_Qty,
           cast(cast(s.Net_Qty AS decimal(18,4)) AS varchar) AS Net_Qty,
           cast(cast(s.Temp AS decimal(18,4)) AS varchar) AS Temperature,
           s.Temp_UOM AS Temperature_UOM, s.Gauge,
           cast(NULL AS varchar) AS Gauge_Ft, cast(NULL AS varchar) AS Gauge_In,
           cast(cast(s.BSW AS decimal(18,4)) AS varchar) AS BSW,
           cast(NULL AS varchar) AS BSW_Ft, cast(NULL AS varchar) AS BSW_In,
           cast(cast(s.Water AS decimal(18,4)) AS varchar) AS Water, s.Units
    FROM ({READINGS_SQL}) s
    JOIN ({plain(CONTAINERS)}) c
      ON {same_sql("s.Ref_Location", "c.Ref_Location")} AND {same_sql("s.Tank", "c.Container_Desc")}
    JOIN ({plain(MATERIALS)}) m
      ON {same_sql("s.Ref_Location", "m.Ref_Location")} AND {same_sql("s.Material", "m.Material")}
"""
UNMAPPED_SQL = f"""
    SELECT * FROM (
        SELECT Ref_Location, Inv_Timestamp, Tank, Material, Gross_Qty,
               CASE WHEN c = 0 AND m = 0 THEN 'container,material'
                    WHEN c = 0 THEN 'container' WHEN m = 0 THEN 'material' ELSE '' END AS missing
        FROM (
            SELECT s.*,
                   CASE WHEN EXISTS (SELECT 1 FROM ({plain(CONTAINERS)}) c
                        WHERE {same_sql("s.Ref_Location", "c.Ref_Location")}
                          AND {same_sql("s.Tank", "c.Container_Desc")}) THEN 1 ELSE 0 END AS c,
                   CASE WHEN EXISTS (SELECT 1 FROM ({plain(MATERIALS)}) m
                        WHERE {same_sql("s.Ref_Location", "m.Ref_Location")}
                          AND {same_sql("s.Material", "m.Material")}) THEN 1 ELSE 0 END AS m
            FROM ({READINGS_SQL}) s
        ) f
    ) g WHERE missing <> ''
"""


def _inventory_merge_sql() -> str:
    have = {
        "Ref_Location", "Container_ID", "Inventory_Date", "Inventory_Time", "Material_ID",
        "Gross_Qty", "Net_Qty",
    }
    columns = ", ".join(
        c if c in have else f"cast(NULL AS varchar) AS {c}" for c in INVENTORY_COLUMNS
    )
    core = f"SELECT {columns} FROM ({plain(INVENTORY_CORE)}) o"
    spec = feed("inventory")
    return merge_sql(core, INVENTORY_SQL, list(INVENTORY_COLUMNS), list(spec.keys), list(spec.updates))


# Orders stand for blends. Measures are text, some of them blank.
def _measure(i: int) -> str:
    blank = ("F", "O", "P")[i % 3]
    return (
        f"CASE WHEN o_orderstatus = '{blank}' THEN '' "
        f"ELSE cast(cast(o_totalprice + {i} AS decimal(18,2)) AS string) END"
    )


def _wide(names) -> str:
    return ", ".join(f"{_measure(i)} AS {name}" for i, name in enumerate(names))


PRED_COLUMNS = feed("blend_pred").columns[2:]
PREDICTIONS = f"""
    SELECT 'SITE' AS Ref_Location, 'B' || cast(o_orderkey AS string) AS Blend_ID,
           {_wide(PRED_COLUMNS)}
    FROM {{orders}}
"""
RECIPES = f"""
    SELECT 'SITE' AS Ref_Location, 'B' || cast(o_orderkey AS string) AS Blend_ID,
           o_orderstatus AS Blend_Rep, substring(o_orderpriority, 1, 1) AS Blend_PlanAct,
           {_wide(RECIPE_MEASURES)}
    FROM {{orders}}
"""


def _lab_step(name: str) -> str:
    if name.endswith("_Date"):
        return "substring(cast(o_orderdate AS string), 1, 10)"
    if name.endswith("_Time"):
        return "CASE WHEN o_orderstatus = 'F' THEN ' ' ELSE '8:30' END"
    return "o_orderpriority"


SAMPLES = f"""
    SELECT 'SITE' AS Ref_Location, 'S' || cast(o_orderkey AS string) AS Sample_ID,
           o_orderstatus AS Test_Rep, 'PUMP' AS Sample_Point,
           cast(o_custkey AS string) AS Material_ID, cast(o_custkey AS string) AS Container_ID,
           {", ".join(f"{_lab_step(c)} AS {c}" for c in LAB_STEP_COLUMNS)},
           '' AS Status, {_wide(LAB_MEASURES)}
    FROM {{orders}}
"""
LAB_CORE = """
    SELECT 'SITE' AS Ref_Location, cast(l_orderkey AS string) AS Sample_ID,
           CASE WHEN l_returnflag = 'R' THEN NULL ELSE cast(l_suppkey AS string) END AS Container_ID,
           cast(l_linenumber AS string) AS Component_ID,
           cast(l_quantity AS string) AS Result_Value
    FROM {lineitem}
"""


def feed_blend_pred(spark, sf_dir):
    stage = normalise(derive(spark, sf_dir, PREDICTIONS), feed("blend_pred").blank_to_null)
    return shown(with_audit(plant.blend_pred_rows(stage), LOAD_TS))


def feed_blend_recipe(spark, sf_dir):
    stage = normalise(derive(spark, sf_dir, RECIPES), feed("blend_recipe").blank_to_null)
    return shown(with_audit(plant.blend_recipe_rows(stage), LOAD_TS))


def feed_blend_lab(spark, sf_dir):
    stage = normalise(derive(spark, sf_dir, SAMPLES), feed("blend_lab").blank_to_null)
    rows = with_audit(plant.blend_lab_rows(stage), LOAD_TS)
    old = derive(spark, sf_dir, LAB_CORE)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    core = old.selectExpr(
        *[f"cast({c if c in old.columns else 'NULL'} AS {kinds[c]}) AS {c}" for c in LAB_COLUMNS]
    )
    return shown(replace_where(with_audit(core, OLD_TS), plant.blend_lab_scope(), rows))


def _decimal(c: str) -> str:
    return f"cast(try_cast(trim({c}) AS decimal(18,4)) AS varchar)"


PRED_SQL = " UNION ALL ".join(
    f"SELECT Ref_Location, Blend_ID, '{k}' AS Component_ID, "
    f"{_decimal({'RVP_80': 'RVP_MinSpec', 'RM2_78': 'RM2_MinSpec'}.get(c, 'NULL'))} AS Spec_Min, "
    f"cast(NULL AS varchar) AS Spec_Max, {_decimal(c)} AS Predicted_Value, "
    f"'{LOAD_TS}' AS Create_Dttm, '{LOAD_TS}' AS Last_Update_Dttm FROM ({plain(PREDICTIONS)}) s"
    for c, k in LAB_MEASURES.items()
)
RECIPE_SQL = " UNION ALL ".join(
    f"SELECT Ref_Location, Blend_ID, Blend_Rep, Blend_PlanAct, '{a}' AS Material_Id, "
    f"'{b}' AS Container_Id, {_decimal(c)} AS Blend_Component_Volume, "
    f"'{LOAD_TS}' AS Create_Dttm, '{LOAD_TS}' AS Last_Update_Dttm FROM ({plain(RECIPES)}) s"
    for c, (a, b) in RECIPE_MEASURES.items()
)


def _lab_sql() -> str:
    have = {"Ref_Location", "Sample_ID", "Container_ID", "Component_ID", "Result_Value"}
    old = ", ".join(c if c in have else f"cast(NULL AS varchar) AS {c}" for c in LAB_COLUMNS)
    parts = [
        f"SELECT {old}, '{OLD_TS}' AS Create_Dttm, '{OLD_TS}' AS Last_Update_Dttm "
        f"FROM ({plain(LAB_CORE)}) o WHERE Container_ID IS NULL "
        "OR NOT cast(Container_ID AS integer) BETWEEN 97 AND 101"
    ]
    for measure, key in LAB_MEASURES.items():
        cells = {"Component_ID": f"'{key}'", "Result_Value": blank_sql(measure), "Status": "NULL"}
        cells |= {"Result_MinSpec": "NULL", "Result_MaxSpec": "NULL"}
        cells |= {
            c: f"CASE WHEN rtrim({c}) = '' THEN NULL ELSE '08:30:00' END"
            for c in LAB_STEP_COLUMNS
            if c.endswith("_Time")
        }
        columns = ", ".join(f"{cells.get(c, c)} AS {c}" for c in LAB_COLUMNS)
        parts.append(f"SELECT {columns}, '{LOAD_TS}', '{LOAD_TS}' FROM ({plain(SAMPLES)}) s")
    return " UNION ALL ".join(parts)


# Line items stand for wide sensor rows: three of fifty pairs are in use, one of
# them only at times. The tag carries the row's key, so readings are unique.
SENSOR_ROWS = """
    SELECT max(l_shipdate) AS ship, 'SITE' AS Ref_Location, l_orderkey, l_linenumber,
           max(l_quantity) AS q, max(l_extendedprice) AS p, max(l_returnflag) AS f
    FROM {lineitem} GROUP BY l_orderkey, l_linenumber
"""
SENSOR_TAGS = {
    1: ("'Q' || cast(l_orderkey AS string) || '.' || cast(l_linenumber AS string)", "q"),
    2: ("'P' || cast(l_orderkey AS string) || '.' || cast(l_linenumber AS string)", "p"),
    50: (
        "CASE WHEN f = 'R' THEN '' ELSE 'Z' || cast(l_orderkey AS string) || '.' "
        "|| cast(l_linenumber AS string) END",
        "q + p",
    ),
}


def _sensor_cells() -> str:
    cells = []
    for i in range(1, 51):
        tag, value = SENSOR_TAGS.get(i, ("''", "NULL"))
        cells.append(f"{tag} AS Tag{i}_ID")
        cells.append(f"cast(cast({value} AS decimal(18,2)) AS string) AS Tag{i}_Value")
    return ", ".join(cells)


SENSOR_WIDE = f"""
    SELECT substring(cast(ship AS string), 1, 19) AS Trans_Timestamp, Ref_Location,
           {_sensor_cells()}
    FROM ({SENSOR_ROWS}) r
"""
SENSOR_CORE = """
    SELECT 'site ' AS Ref_Location,
           'q' || cast(l_orderkey AS string) || '.' || cast(l_linenumber AS string) AS Tag_ID,
           substring(cast(max(l_shipdate) AS string), 1, 19) AS Trans_Timestamp, '-1' AS Tag_Value
    FROM {lineitem} WHERE l_linestatus = 'O' GROUP BY l_orderkey, l_linenumber
"""
SENSOR = ["Ref_Location", "Tag_ID", "Trans_Timestamp", "Tag_Value"]


def feed_sensor(spark, sf_dir):
    spec = feed("sensor")
    readings = plant.sensor_readings(derive(spark, sf_dir, SENSOR_WIDE))
    core = derive(spark, sf_dir, SENSOR_CORE).selectExpr(
        "Ref_Location", "Tag_ID", "cast(Trans_Timestamp AS timestamp_ntz) AS Trans_Timestamp", "Tag_Value"
    )
    return shown(
        merge_upsert(
            with_audit(core, OLD_TS), readings,
            keys=spec.keys, updates=spec.updates, load_ts=LOAD_TS,
            nullable_keys=(),
        )
    )


def _sensor_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT Ref_Location, {tag} AS Tag_ID, substr(cast(ship AS varchar), 1, 19) "
        f"AS Trans_Timestamp, cast(cast({value} AS decimal(18,2)) AS varchar) AS Tag_Value "
        f"FROM ({plain(SENSOR_ROWS)}) r WHERE {tag} <> ''"
        for tag, value in SENSOR_TAGS.values()
    )
    return merge_sql(plain(SENSOR_CORE), long, SENSOR, SENSOR[:3], ["Tag_Value"], SENSOR[:2])


# Events stand for readings. A batch brings some again as they are, some with
# another value or none that is a number, and some that are new.
EVENT_READINGS = """
    SELECT 'SITE' AS Ref_Location, event_type AS Tag_ID, ts, cast(cast(max(value) AS decimal(18,4)) AS string) AS v,
           min(event_id) AS e
    FROM {events} GROUP BY event_type, ts
"""
STORED_READINGS = f"SELECT Ref_Location, Tag_ID, ts, v AS Tag_Value FROM ({EVENT_READINGS}) r WHERE e % 4 <> 0"
BATCH_READINGS = f"""
    SELECT lower(Ref_Location) AS Ref_Location, Tag_ID || ' ' AS Tag_ID, ts,
           CASE e % 9 WHEN 0 THEN 'off' WHEN 3 THEN cast(cast(v AS decimal(18,4)) + 1 AS string) ELSE v END AS Tag_Value
    FROM ({EVENT_READINGS}) r WHERE e % 3 = 0
"""


def _sensor_rows(spark, sf_dir, sql):
    rows = derive(spark, sf_dir, sql).withColumn("Trans_Timestamp", F.col("ts").cast("timestamp_ntz"))
    return rows.select("Ref_Location", "Tag_ID", "Trans_Timestamp", "Tag_Value")


def sensor_daily_refresh(spark, sf_dir):
    """Daily states brought up to date by what a batch changes, not by reading the days again."""
    spec = feed("sensor")
    stored, batch = (_sensor_rows(spark, sf_dir, x) for x in (STORED_READINGS, BATCH_READINGS))
    changed = loader.changed_readings(stored, batch, spec.keys).persist()
    after = merge_upsert(
        with_audit(stored, OLD_TS), batch, keys=spec.keys, updates=spec.updates, load_ts=LOAD_TS,
        nullable_keys=(), unique_stage=True,
    )
    states = daily_states(stored, loader.DAILY_KEYS[:2], "Trans_Timestamp", "Tag_Value")
    merged = loader.merged_sensor_states(states, changed, after).withColumn("Avg_Value", average())
    named = merged.withColumns({"Ref_Location": F.lower("Ref_Location"), "Tag_ID": F.rtrim("Tag_ID")})
    # New readings are written as the batch spells them: one group per key all the same.
    rows = named.groupBy(*loader.DAILY_KEYS).agg(
        F.sum("Readings").alias("Readings"), F.min("Min_Value").alias("Min_Value"), F.max("Max_Value").alias("Max_Value"),
        (F.sum("Number_Sum").cast("double") / F.sum("Numbers")).alias("Avg_Value"),
        F.max_by("Last_Value", "Last_Stamp").alias("Last_Value"),
    )
    return shown(rows)


REFRESH_SQL = f"""
    WITH readings AS (
        SELECT Tag_ID, ts, Tag_Value FROM ({plain(STORED_READINGS)}) s
        WHERE (Tag_ID, ts) NOT IN (SELECT (rtrim(Tag_ID), ts) FROM ({plain(BATCH_READINGS)}) b)
        UNION ALL SELECT rtrim(Tag_ID), ts, Tag_Value FROM ({plain(BATCH_READINGS)}) b
    ), numbers AS (SELECT *, try_cast(Tag_Value AS decimal(28,6)) AS exact, try_cast(Tag_Value AS double) AS number FROM readings)
    SELECT 'site' AS Ref_Location, Tag_ID, cast(cast(ts AS date) AS varchar) AS Reading_Date, count(*) AS Readings,
           min(number) AS Min_Value, max(number) AS Max_Value, cast(sum(exact) AS double) / count(exact) AS Avg_Value,
           arg_max(number, ts) FILTER (WHERE number IS NOT NULL) AS Last_Value
    FROM numbers GROUP BY Tag_ID, cast(ts AS date)
"""

# Line items as readings of a supplier and day: the highest order and line came last.
ARRIVALS = """
    SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'SITE' ELSE 'site ' END AS Ref_Location,
           'S' || cast(l_suppkey AS string) AS Tag_ID, cast(l_shipdate AS string) AS day,
           cast(l_quantity AS string) AS Tag_Value, l_orderkey, l_linenumber
    FROM {lineitem}
"""


def sensor_latest_reading(spark, sf_dir):
    rows = derive(spark, sf_dir, ARRIVALS).withColumn("Trans_Timestamp", F.substring("day", 1, 10)).drop("day")
    rows = latest_per_key(rows, feed("sensor").keys, ("l_orderkey", "l_linenumber"))
    return rows.select("Ref_Location", "Tag_ID", "Trans_Timestamp", F.col("Tag_Value").cast("double").alias("Tag_Value"))


LATEST_SQL = f"""
    SELECT Ref_Location, Tag_ID, substr(day, 1, 10) AS Trans_Timestamp, cast(Tag_Value AS double) AS Tag_Value
    FROM ({plain(ARRIVALS)}) a
    QUALIFY row_number() OVER (PARTITION BY lower(rtrim(Ref_Location)), Tag_ID, substr(day, 1, 10)
                               ORDER BY l_orderkey DESC, l_linenumber DESC) = 1
"""


QUERIES = [
    Query("sensor_daily_refresh", sensor_daily_refresh, REFRESH_SQL),
    Query("sensor_latest_reading", sensor_latest_reading, LATEST_SQL),
    Query("inventory_decode", inventory_decode, INVENTORY_SQL),
    Query("inventory_unmapped", inventory_unmapped, UNMAPPED_SQL),
    Query("feed_inventory", feed_inventory, _inventory_merge_sql()),
    Query("feed_blend_pred", feed_blend_pred, PRED_SQL),
    Query("feed_blend_recipe", feed_blend_recipe, RECIPE_SQL),
    Query("feed_blend_lab", feed_blend_lab, _lab_sql()),
    Query("feed_sensor", feed_sensor, _sensor_sql()),
]
