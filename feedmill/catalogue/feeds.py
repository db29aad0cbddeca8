"""The feeds whose core table has the landed columns, one query each.

Orders stand for the feed's records. Each landed column gets text according to
its role; the feed's own clean-up list, types, keys and update list do the rest.
"""

from __future__ import annotations

from feedmill.catalogue.base import LOAD_TS, OLD_TS, Query, blank_sql, derive, merge_sql, plain, shown
from feedmill.feeds import FEEDS, RELOAD, UPSERT, FeedSpec
from feedmill.operators.normalise import normalise, with_audit
from feedmill.operators.replace import reload
from feedmill.operators.upsert import merge_upsert
from feedmill.plans.plant import typed_rows
from feedmill.tables import table

SPECIAL = {
    "blend_lab", "blend_pred", "blend_recipe", "inventory", "sensor", "price_crack",
    "price_futures", "price_opisfeed", "price_opisspot", "price_platts",
}
PLAIN = [s for s in FEEDS.values() if s.name not in SPECIAL]


def _identity(spec: FeedSpec) -> str:
    """The landed column that holds the order number and so makes records unique."""
    texts = [
        c.name
        for c in spec.layout
        if c.required and c.width >= 10 and c.name not in (*spec.dates, *spec.times)
        and c.name != "Ref_Location"
    ]
    return texts[0] if texts else "Ref_Location"


def _cell(spec: FeedSpec, name: str, order: str) -> str:
    """Text for one landed cell: values, blanks and empty cells by role."""
    i = spec.columns.index(name)
    if name == _identity(spec):
        return order
    if name in spec.dates:
        day = "substring(cast(o_orderdate AS string), 1, 10)"
        if name in spec.required:
            return day
        return f"CASE o_orderstatus WHEN 'P' THEN '' ELSE {day} END"
    if name in spec.times:
        if name in spec.required:
            return "'8:05'"
        return "CASE o_orderstatus WHEN 'F' THEN ' ' ELSE '10:20:30' END"
    if name in spec.numbers:
        blank = ("F", "O", "P")[i % 3]
        price = f"cast(cast(o_totalprice + {i} AS decimal(18,2)) AS string)"
        return f"CASE WHEN o_orderstatus = '{blank}' THEN '  ' ELSE {price} END"
    if name in spec.required:
        return "'B' || o_orderstatus" if i % 2 else "'S'"
    blank = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")[i % 4]
    return f"CASE WHEN o_orderpriority = '{blank}' THEN '' ELSE substring(o_orderpriority, 1, 4) END"


def stage_sql(spec: FeedSpec, order: str) -> str:
    cells = ", ".join(f"{_cell(spec, c, order)} AS {c}" for c in spec.columns)
    return f"SELECT {cells} FROM {{orders}}"


# Core and files hold every order, numbered in different case. Low-priority orders
# have another number in the core: those rows stay, and their file rows are new.
CORE_ORDER = (
    "CASE o_orderpriority WHEN '5-LOW' THEN 'c' ELSE 'n' END || cast(o_orderkey AS string)"
)
FILE_ORDER = "'N' || cast(o_orderkey AS string)"


def core_sql(spec: FeedSpec) -> str:
    """The core's records: the files' keys, other descriptive texts."""
    same = {*spec.keys, *spec.numbers, *spec.dates, *spec.times}
    cells = [
        f"{_cell(spec, c, CORE_ORDER) if c in same else _quoted('old')} AS {c}"
        for c in spec.columns
    ]
    return f"SELECT {', '.join(cells)} FROM {{orders}}"


def _quoted(text: str) -> str:
    return f"'{text}'"


def _typed(spec: FeedSpec, spark, sf_dir, sql: str):
    return typed_rows(normalise(derive(spark, sf_dir, sql), spec.blank_to_null), spec)


def _reload(spec: FeedSpec):
    def build(spark, sf_dir):
        rows = _typed(spec, spark, sf_dir, stage_sql(spec, FILE_ORDER))
        core = table(spec.table)
        return shown(reload(rows, core.data_columns, LOAD_TS, core.audit))

    return build


def _upsert(spec: FeedSpec):
    """The order number makes every file row's key unique."""

    def build(spark, sf_dir):
        core = with_audit(_typed(spec, spark, sf_dir, core_sql(spec)), OLD_TS)
        stage = _typed(spec, spark, sf_dir, stage_sql(spec, FILE_ORDER))
        return shown(
            merge_upsert(
                core, stage, keys=spec.keys, updates=spec.updates, load_ts=LOAD_TS,
                nullable_keys=spec.nullable_keys,
            )
        )

    return build


# --------------------------------------------------------------------------
# SQL twins
# --------------------------------------------------------------------------


def _typed_sql(spec: FeedSpec, sql: str) -> str:
    kept = {"CF_Date", "BOL_Product", "Extract_Group"}
    if spec.name == "sensor_loadparams":
        kept.add("Ref_Location")
    required = {c.name for c in spec.layout if c.required}
    cells = []
    for c in spec.columns:
        text = c if c in required or c in kept else blank_sql(c)
        if c in spec.numbers:
            text = f"cast(try_cast(trim({c}) AS decimal(18,4)) AS varchar)"
        if c in spec.times:
            text = (
                f"CASE WHEN rtrim({c}) = '' THEN NULL "
                f"WHEN length({c}) < 8 THEN lpad({c}, 5, '0') || ':00' ELSE {c} END"
            )
        cells.append(f"{text} AS {c}")
    return f"SELECT {', '.join(cells)} FROM ({plain(sql)}) s"


def _reload_sql(spec: FeedSpec) -> str:
    stamps = "".join(f", '{LOAD_TS}' AS {a}" for a in spec.audit)
    return f"SELECT *{stamps} FROM ({_typed_sql(spec, stage_sql(spec, FILE_ORDER))}) t"


def _upsert_sql(spec: FeedSpec) -> str:
    return merge_sql(
        _typed_sql(spec, core_sql(spec)),
        _typed_sql(spec, stage_sql(spec, FILE_ORDER)),
        spec.columns,
        list(spec.keys),
        list(spec.updates),
    )


QUERIES = [Query(f"feed_{s.name}", _reload(s), _reload_sql(s)) for s in PLAIN if s.write == RELOAD]
QUERIES += [Query(f"feed_{s.name}", _upsert(s), _upsert_sql(s)) for s in PLAIN if s.write == UPSERT]
