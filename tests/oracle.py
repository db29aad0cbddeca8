"""Compare a query with its SQL twin, value by value."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from feedmill.catalogue.base import SOURCES


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(query, spark, sf_dir, con) -> str | None:
    df = query.build(spark, sf_dir)
    ours = _bag(df.columns, df.collect())
    result = con.execute(query.sql)
    names = [d[0] for d in result.description]
    theirs = _bag(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if ours == theirs:
        return None
    only = list((ours - theirs).items())[:3]
    missing = list((theirs - ours).items())[:3]
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}\n"
        f"columns {sorted(names)}\nonly ours {only}\nonly SQL {missing}"
    )
