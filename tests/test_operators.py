"""Operators on small inputs, with the cases the shared tables do not hold."""

from pyspark.sql import functions as F

from feedmill.functions.typing import compact_clock, compact_day, to_clock, to_day, to_number
from feedmill.operators.identity import arrival_identity
from feedmill.operators.lookup import decode
from feedmill.operators.replace import number_between, replace_where
from feedmill.operators.reshape import unpivot_pairs
from feedmill.plans.prices import contract_month


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "x string").select(expr(F.col("x"))).first()[0]


def test_text_to_values(spark):
    assert [one(spark, t, to_clock) for t in ("8:05", "08:05:09", "24:00", "x", "")] == [
        "08:05:00", "08:05:09", None, None, None,
    ]
    assert str(one(spark, " 2024-02-29 ", to_day)) == "2024-02-29"
    assert one(spark, "2023-02-29", to_day) is None
    assert str(one(spark, " 1.5 ", to_number)) == "1.5000"
    assert one(spark, "1,5", to_number) is None
    assert one(spark, "20240115", compact_clock) == "00:00:00"
    assert one(spark, "20240115153001", compact_clock) == "15:30:01"
    assert str(one(spark, "20240115153001", compact_day)) == "2024-01-15"


def test_contract_months(spark):
    rows = [("F", "25"), ("z", "69"), ("H", "70"), ("A", "25"), ("FG", "25"), ("F", "x")]
    df = spark.createDataFrame(rows, "m string, y string")
    got = [r[0] for r in df.select(contract_month(F.col("m"), F.col("y"))).collect()]
    assert [d and str(d) for d in got] == [
        "2025-01-01", "2069-12-01", "1970-03-01", None, None, None,
    ]


def test_range_on_text_ids(spark):
    ids = ["97", " 101 ", "96", "102", "100.5", "T98", "", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    scope = number_between(F.col("id"), 97, 101)
    kept = replace_where(df, scope, df.limit(0)).collect()
    assert [r[0] for r in kept] == ["96", "102", "T98", "", None]


def test_decode_fans_out_and_ignores_case(spark):
    rows = spark.createDataFrame([("a ", 1), ("B", 2), (None, 3), ("c", 4)], "k string, n int")
    entries = spark.createDataFrame([("A", "x"), ("a", "y"), ("b  ", "z"), (None, "w")], "d string, v string")  # noqa: E501
    got = decode(rows, entries, [("k", "d")], ["v"]).collect()
    assert sorted((r["n"], r["v"]) for r in got) == [(1, "x"), (1, "y"), (2, "z")]


def test_unused_pairs_fall_away(spark):
    df = spark.createDataFrame([(1, "t", "5", " ", "6", None, "7", "u", None)],
                               "id int, t1 string, v1 string, t2 string, v2 string, t3 string, v3 string, t4 string, v4 string")  # noqa: E501
    pairs = [(f"t{i}", f"v{i}") for i in range(1, 5)]
    assert [tuple(r) for r in unpivot_pairs(df, ["id"], pairs).collect()] == [(1, "t", "5"), (1, "u", None)]  # noqa: E501


def test_identity_is_dense_over_many_partitions(spark):
    df = spark.range(0, 1000, 1, 7).filter("id % 3 <> 0")
    got = [r["Row_Num"] for r in arrival_identity(df).collect()]
    assert sorted(got) == list(range(1, len(got) + 1))
