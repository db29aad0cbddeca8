"""The upsert and its edge cases, on orders and customers."""

from __future__ import annotations

from feedmill.catalogue.base import LOAD_TS, OLD_TS, Query, derive, merge_sql, plain, shown, source
from feedmill.operators.normalise import with_audit
from feedmill.operators.upsert import merge_upsert, multi_match

ORDER = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
UPDATES = ["o_orderstatus", "o_totalprice", "o_orderpriority"]

CORE = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM {orders}"

# Doubling the key leaves odd core keys alone, updates half of the even ones and
# inserts the rest. Pending orders write NULL over the core's status.
STAGE = """
    SELECT o_orderkey * 2 AS o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE lower(o_orderstatus) END AS o_orderstatus,
           o_totalprice + 1 AS o_totalprice,
           'X' || o_orderpriority AS o_orderpriority
    FROM {orders}
"""

# No line item key exists in the core; order numbers repeat within the stage.
NEW_STAGE = """
    SELECT -1 - l_orderkey AS o_orderkey, l_linestatus AS o_orderstatus,
           l_extendedprice AS o_totalprice, cast(NULL AS string) AS o_orderpriority
    FROM {lineitem}
"""

NULL_KEY_CORE = """
    SELECT o_orderkey, o_orderstatus, o_totalprice,
           CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderpriority END
               AS o_orderpriority
    FROM {orders}
"""
NULL_KEY_STAGE = """
    SELECT o_orderkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
           CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderpriority END
               AS o_orderpriority
    FROM {orders}
"""

NAMES_CORE = "SELECT lower(c_name) AS c_name, c_mktsegment, c_acctbal FROM {customer}"
NAMES_STAGE = """
    SELECT 'CUSTOMER#' || lpad(cast(c_custkey * 2 AS string), 9, '0') || '  ' AS c_name,
           lower(c_mktsegment) AS c_mktsegment, c_acctbal + 1 AS c_acctbal
    FROM {customer}
"""
NAMES = ["c_name", "c_mktsegment", "c_acctbal"]


def _merge(core_sql: str, stage_sql: str, keys, updates, **how):
    def build(spark, sf_dir):
        core = with_audit(derive(spark, sf_dir, core_sql), OLD_TS)
        stage = derive(spark, sf_dir, stage_sql)
        return shown(
            merge_upsert(core, stage, keys=keys, updates=updates, load_ts=LOAD_TS, **how)
        )

    return build


def _merge_query(name, core, stage, columns, keys, updates, text_keys, **how) -> Query:
    sql = merge_sql(plain(core), plain(stage), columns, keys, updates, text_keys)
    return Query(name, _merge(core, stage, keys, updates, **how), sql)


def merge_multi_match(spark, sf_dir):
    core = source(spark, sf_dir, "orders").select("o_orderkey")
    stage = source(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS o_orderkey")
    return multi_match(core, stage, ["o_orderkey"])


KEY = ["o_orderkey"]

QUERIES = [
    _merge_query("merge_upsert_full", CORE, STAGE, ORDER, KEY, UPDATES, [], nullable_keys=[]),
    _merge_query(
        "merge_upsert_small_stage", CORE, STAGE, ORDER, KEY, UPDATES, [],
        nullable_keys=[],
    ),
    _merge_query("merge_insert_only", CORE, NEW_STAGE, ORDER, KEY, UPDATES, []),
    _merge_query("merge_partial_update", CORE, STAGE, ORDER, KEY, ["o_totalprice"], []),
    _merge_query(
        "merge_null_key", NULL_KEY_CORE, NULL_KEY_STAGE, ORDER,
        ["o_orderkey", "o_orderpriority"], ["o_orderstatus", "o_totalprice"], ["o_orderpriority"],
        nullable_keys=["o_orderpriority"],
    ),
    _merge_query(
        "merge_null_key_small_stage", NULL_KEY_CORE, NULL_KEY_STAGE, ORDER,
        ["o_orderkey", "o_orderpriority"], ["o_orderstatus", "o_totalprice"], ["o_orderpriority"],
        nullable_keys=["o_orderpriority"],
    ),
    _merge_query(
        "merge_ci_key", NAMES_CORE, NAMES_STAGE, NAMES, ["c_name"], ["c_acctbal"], ["c_name"],
        nullable_keys=[],
    ),
    Query(
        "merge_multi_match",
        merge_multi_match,
        "SELECT l_orderkey AS o_orderkey, count(*) AS copies FROM lineitem "
        "WHERE l_orderkey IN (SELECT o_orderkey FROM orders) "
        "GROUP BY l_orderkey HAVING count(*) > 1",
    ),
]
