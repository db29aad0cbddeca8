"""Landing, clean-up, checks, reload, replacement, unpivot and identity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.catalogue.base import LOAD_TS, OLD_TS, Query, derive, plain, shown, source
from feedmill.functions.typing import stamp_clock, stamp_day, to_day, to_number
from feedmill.operators.identity import arrival_identity
from feedmill.operators.normalise import normalise, with_audit, with_typed_nulls
from feedmill.operators.quality import (
    audit_counts,
    duplicate_keys,
    null_violations,
    row_fault,
    width_violations,
)
from feedmill.operators.replace import number_between, reload, replace_where
from feedmill.operators.reshape import (
    unpivot_measures,
    unpivot_pairs,
    unpivot_two_keys,
    unpivot_with_companion,
)
from feedmill.operators.summary import daily_summary

BLANKED = """
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN ''
                WHEN o_orderpriority = '1-URGENT' THEN '   '
                ELSE o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS o_comment
    FROM {orders}
"""


def null_normalise(spark, sf_dir):
    stage = derive(spark, sf_dir, BLANKED).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return normalise(stage, ["o_orderpriority"])


def null_normalise_subset(spark, sf_dir):
    return normalise(derive(spark, sf_dir, BLANKED), ["o_orderpriority"])


UNSET = """
    SELECT c_custkey,
           CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS c_name
    FROM {customer}
"""


def not_null_violations(spark, sf_dir):
    return null_violations(derive(spark, sf_dir, UNSET), ["c_custkey", "c_mktsegment", "c_name"])


WIDTHS = {"p_name": 9, "p_brand": 7, "p_type": 6}


def width_violations_query(spark, sf_dir):
    return width_violations(source(spark, sf_dir, "part"), ["p_partkey"], WIDTHS)


def stage_duplicate_keys(spark, sf_dir):
    return duplicate_keys(source(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


SEGMENTS = """
    SELECT CASE WHEN c_custkey % 2 = 0 THEN concat(c_mktsegment, '  ') ELSE lower(c_mktsegment)
           END AS segment, c_nationkey AS nation
    FROM {customer}
"""


def stage_duplicate_text_keys(spark, sf_dir):
    return duplicate_keys(derive(spark, sf_dir, SEGMENTS), ["segment", "nation"])


AUDITED = {
    "orders": (
        "SELECT l_orderkey * 2 AS k, l_returnflag = 'R' AS bad FROM {lineitem}",
        "SELECT o_orderkey AS k FROM {orders}",
    ),
    "customer": (
        "SELECT o_custkey * 2 AS k, o_orderstatus = 'P' AS bad FROM {orders}",
        "SELECT c_custkey AS k FROM {customer}",
    ),
    "part": (
        "SELECT l_partkey AS k, l_tax = 0 AS bad FROM {lineitem}",
        "SELECT p_partkey AS k FROM {part}",
    ),
}


def audit_row_counts(spark, sf_dir):
    rows = [
        audit_counts(
            derive(spark, sf_dir, stage), derive(spark, sf_dir, core), ["k"], F.col("bad")
        ).withColumn("feed", F.lit(name))
        for name, (stage, core) in AUDITED.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _audit_sql(name: str, stage: str, core: str) -> str:
    return f"""
        SELECT '{name}' AS feed, count(*) AS scanned,
               count(*) FILTER (WHERE bad) AS rejected,
               count(*) FILTER (WHERE NOT bad AND k IN (SELECT k FROM ({plain(core)}) c)) AS matched,
               count(*) FILTER (WHERE NOT bad AND k NOT IN (SELECT k FROM ({plain(core)}) c))
                   AS inserted
        FROM ({plain(stage)}) s
    """


RELOADED = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]


def reload_with_audit(spark, sf_dir):
    return shown(reload(source(spark, sf_dir, "customer"), RELOADED, LOAD_TS))


TYPED_NULLS = {"Spec_Min": "string", "Spec_Max": "string", "Price_Open": "double"}


def typed_null_columns(spark, sf_dir):
    parts = source(spark, sf_dir, "part").select("p_partkey", "p_name")
    return with_typed_nulls(parts, TYPED_NULLS)


AS_TEXT = """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE cast(o_totalprice AS string) END AS price,
           CASE WHEN o_orderpriority = '5-LOW' THEN ''
                WHEN o_orderpriority = '2-HIGH' THEN '31/12/1999'
                ELSE substring(cast(o_orderdate AS string), 1, 10) END AS day
    FROM {orders}
"""


def typed_core_casts(spark, sf_dir):
    rows = derive(spark, sf_dir, AS_TEXT)
    typed = {"price": to_number(F.col("price")), "day": to_day(F.col("day"))}
    fault = row_fault([], {}, typed)
    return shown(
        rows.select(
            "o_orderkey", typed["price"].alias("price"), typed["day"].alias("day"),
            fault.alias("reject_reason"),
        )
    )


CORE_TANKS = """
    SELECT l_orderkey,
           CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
                THEN 'T' || cast(l_suppkey AS string)
                ELSE cast(l_suppkey AS string) END AS Container_ID,
           l_quantity
    FROM {lineitem}
"""
NEW_TANKS = """
    SELECT o_orderkey AS l_orderkey, cast(o_custkey AS string) AS Container_ID,
           o_totalprice AS l_quantity
    FROM {orders}
"""


def replace_where_between(spark, sf_dir):
    core = with_audit(derive(spark, sf_dir, CORE_TANKS), OLD_TS)
    rows = with_audit(derive(spark, sf_dir, NEW_TANKS), LOAD_TS)
    return shown(replace_where(core, number_between(F.col("Container_ID"), 10, 20), rows))


# Unpivots: line items stand for samples, their amounts for measures.
MEASURES = {"l_quantity": 1, "l_extendedprice": 2, "l_discount": 3, "l_tax": 4}
SAMPLE_IDS = ["l_orderkey", "l_linenumber"]


def unpivot_measures_query(spark, sf_dir):
    return unpivot_measures(source(spark, sf_dir, "lineitem"), SAMPLE_IDS, MEASURES)


def unpivot_with_spec(spark, sf_dir):
    return unpivot_with_companion(
        source(spark, sf_dir, "lineitem"),
        SAMPLE_IDS,
        MEASURES,
        {"l_tax": "l_discount"},
        companion_type="double",
    ).withColumn("Spec_Max", F.lit(None).cast("double"))


def _measures_sql(select) -> str:
    return " UNION ALL ".join(select(c, k) for c, k in MEASURES.items())


AMOUNTS = {"o_totalprice": (42, 49), "o_custkey": (44, 9)}


def unpivot_two_keys_query(spark, sf_dir):
    orders = source(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.col("o_custkey").cast("double")
    )
    return unpivot_two_keys(orders, ["o_orderkey"], AMOUNTS)


TAG_PAIRS = """
    SELECT l_orderkey, l_linenumber,
           l_returnflag AS t1, l_quantity AS v1,
           CASE WHEN l_linestatus = 'F' THEN '  ' ELSE l_linestatus END AS t2,
           l_extendedprice AS v2,
           CASE WHEN l_discount = 0 THEN NULL ELSE 'D' END AS t3, l_discount AS v3
    FROM {lineitem}
"""


def unpivot_pairs_query(spark, sf_dir):
    pairs = [("t1", "v1"), ("t2", "v2"), ("t3", "v3")]
    return unpivot_pairs(derive(spark, sf_dir, TAG_PAIRS), SAMPLE_IDS, pairs)


def row_identity(spark, sf_dir):
    customers = source(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return arrival_identity(customers)


def sensor_daily_summary(spark, sf_dir):
    events = source(spark, sf_dir, "events").select("event_type", "ts", "value")
    return shown(daily_summary(events, ["event_type"], "ts", "value"))


STAMPS = "SELECT event_id, cast(ts AS string) AS stamp FROM {events}"


def timestamp_split(spark, sf_dir):
    rows = derive(spark, sf_dir, STAMPS)
    return shown(
        rows.select(
            "event_id",
            stamp_day(F.col("stamp")).alias("day"),
            stamp_clock(F.col("stamp")).alias("clock"),
        )
    )


QUERIES = [
    Query(
        "null_normalise",
        null_normalise,
        f"""SELECT o_orderkey, o_orderstatus,
                   CASE WHEN rtrim(o_orderpriority) = '' THEN NULL ELSE o_orderpriority END
                       AS o_orderpriority
            FROM ({plain(BLANKED)}) s""",
    ),
    Query(
        "null_normalise_subset",
        null_normalise_subset,
        f"""SELECT o_orderkey, o_orderstatus,
                   CASE WHEN rtrim(o_orderpriority) = '' THEN NULL ELSE o_orderpriority END
                       AS o_orderpriority,
                   o_comment
            FROM ({plain(BLANKED)}) s""",
    ),
    Query(
        "not_null_violations",
        not_null_violations,
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS violations "
            f"FROM ({plain(UNSET)}) s WHERE {c} IS NULL"
            for c in ("c_custkey", "c_mktsegment", "c_name")
        ),
    ),
    Query(
        "width_violations",
        width_violations_query,
        " UNION ALL ".join(
            f"SELECT p_partkey, '{c}' AS column_name, cast({w} AS bigint) AS max_width, "
            f"length({c}) AS actual_width FROM part WHERE length({c}) > {w}"
            for c, w in WIDTHS.items()
        ),
    ),
    Query(
        "stage_duplicate_keys",
        stage_duplicate_keys,
        "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    ),
    Query(
        "stage_duplicate_text_keys",
        stage_duplicate_text_keys,
        "SELECT lower(rtrim(segment)) AS segment, nation, count(*) AS copies "
        f"FROM ({plain(SEGMENTS)}) s WHERE segment IS NOT NULL AND nation IS NOT NULL "
        "GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    Query(
        "audit_row_counts",
        audit_row_counts,
        " UNION ALL ".join(_audit_sql(n, s, c) for n, (s, c) in AUDITED.items()),
    ),
    Query(
        "reload_with_audit",
        reload_with_audit,
        f"SELECT {', '.join(RELOADED)}, '{LOAD_TS}' AS Create_Dttm, "
        f"'{LOAD_TS}' AS Last_Update_Dttm FROM customer",
    ),
    Query(
        "typed_null_columns",
        typed_null_columns,
        "SELECT p_partkey, p_name, cast(NULL AS varchar) AS Spec_Min, "
        "cast(NULL AS varchar) AS Spec_Max, cast(NULL AS double) AS Price_Open FROM part",
    ),
    Query(
        "typed_core_casts",
        typed_core_casts,
        f"""SELECT o_orderkey,
                   cast(try_cast(price AS decimal(18,4)) AS varchar) AS price,
                   cast(try_cast(day AS date) AS varchar) AS day,
                   CASE WHEN try_cast(price AS decimal(18,4)) IS NULL THEN 'type:price'
                        WHEN try_cast(day AS date) IS NULL THEN 'type:day' END AS reject_reason
            FROM ({plain(AS_TEXT)}) s""",
    ),
    Query(
        "replace_where_between",
        replace_where_between,
        f"""SELECT *, '{OLD_TS}' AS Create_Dttm, '{OLD_TS}' AS Last_Update_Dttm
            FROM ({plain(CORE_TANKS)}) c
            WHERE NOT coalesce(try_cast(Container_ID AS integer) BETWEEN 10 AND 20, false)
            UNION ALL
            SELECT *, '{LOAD_TS}', '{LOAD_TS}' FROM ({plain(NEW_TANKS)}) s""",
    ),
    Query(
        "unpivot_measures",
        unpivot_measures_query,
        _measures_sql(
            lambda c, k: f"SELECT l_orderkey, l_linenumber, '{k}' AS Component_ID, "
            f"{c} AS Result_Value FROM lineitem"
        ),
    ),
    Query(
        "unpivot_with_spec",
        unpivot_with_spec,
        _measures_sql(
            lambda c, k: f"SELECT l_orderkey, l_linenumber, '{k}' AS Component_ID, "
            f"{'l_discount' if c == 'l_tax' else 'cast(NULL AS double)'} AS Spec_Min, "
            f"{c} AS Predicted_Value, cast(NULL AS double) AS Spec_Max FROM lineitem"
        ),
    ),
    Query(
        "unpivot_two_keys",
        unpivot_two_keys_query,
        " UNION ALL ".join(
            f"SELECT o_orderkey, '{a}' AS Material_Id, '{b}' AS Container_Id, "
            f"cast({c} AS double) AS Blend_Component_Volume FROM orders"
            for c, (a, b) in AMOUNTS.items()
        ),
    ),
    Query(
        "unpivot_pairs",
        unpivot_pairs_query,
        " UNION ALL ".join(
            f"SELECT l_orderkey, l_linenumber, t{i} AS Tag_ID, v{i} AS Tag_Value "
            f"FROM ({plain(TAG_PAIRS)}) s WHERE rtrim(t{i}) <> ''"
            for i in (1, 2, 3)
        ),
    ),
    Query(
        "row_identity",
        row_identity,
        "SELECT row_number() OVER (ORDER BY c_custkey) AS Row_Num, c_custkey, c_name FROM customer",
    ),
    Query(
        "sensor_daily_summary",
        sensor_daily_summary,
        """SELECT event_type, cast(cast(ts AS date) AS varchar) AS Reading_Date,
                  count(*) AS Readings, min(value) AS Min_Value, max(value) AS Max_Value,
                  cast(sum(cast(value AS decimal(28,6))) AS double) / count(value) AS Avg_Value,
                  arg_max(value, ts) AS Last_Value
           FROM events GROUP BY event_type, cast(ts AS date)""",
    ),
    Query(
        "timestamp_split",
        timestamp_split,
        "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S') AS clock "
        "FROM events",
    ),
]

__all__ = ["QUERIES"]
