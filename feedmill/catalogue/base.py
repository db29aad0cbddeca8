"""Shared pieces of the query catalogue."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_TS = "2024-06-01 00:00:00"
OLD_TS = "2023-01-01 00:00:00"

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a derivation on the test tables it names in braces."""
    names = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{n: source(spark, sf_dir, n) for n in names})


def plain(sql: str) -> str:
    """The same derivation with bare table names."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def shown(df: DataFrame) -> DataFrame:
    """Dates, timestamps and decimals as text, so that both engines print alike."""

    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType)

    def cell(f: T.StructField):
        c = F.col(f.name)
        return c.cast("string").alias(f.name) if isinstance(f.dataType, kinds) else c

    return df.select(*[cell(f) for f in df.schema.fields])


def blank_sql(c: str) -> str:
    return f"CASE WHEN rtrim({c}) = '' THEN NULL ELSE {c} END"


def same_sql(a: str, b: str) -> str:
    return f"lower(rtrim({a})) = lower(rtrim({b}))"


def merge_sql(
    core: str,
    stage: str,
    columns: list[str],
    keys: list[str],
    updates: list[str],
    text_keys: list[str] | None = None,
) -> str:
    """An upsert as SQL: full outer join and a CASE on which side is there."""
    folded = set(keys if text_keys is None else text_keys)
    on = " AND ".join(
        same_sql(f"c.{k}", f"s.{k}") if k in folded else f"c.{k} = s.{k}" for k in keys
    )
    out = []
    for c in columns:
        first, other = ("s", "c") if c in updates else ("c", "s")
        out.append(f"CASE WHEN {first}.there THEN {first}.{c} ELSE {other}.{c} END AS {c}")
    out.append(f"CASE WHEN c.there THEN '{OLD_TS}' ELSE '{LOAD_TS}' END AS Create_Dttm")
    out.append(f"CASE WHEN s.there THEN '{LOAD_TS}' ELSE '{OLD_TS}' END AS Last_Update_Dttm")
    return (
        f"SELECT {', '.join(out)} FROM (SELECT *, true AS there FROM ({core}) q) c "
        f"FULL OUTER JOIN (SELECT *, true AS there FROM ({stage}) q) s ON {on}"
    )
