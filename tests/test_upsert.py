"""The upsert against a plain Python model, in both plans."""

import random

import pytest
from pyspark.sql import functions as F

from feedmill.operators.upsert import merge_upsert, multi_match

OLD, NEW = "2023-01-01 00:00:00", "2024-01-01 00:00:00"
SCHEMA = "k1 string, k2 int, v string, w int"


def fold(k):
    return k.rstrip(" ").lower() if isinstance(k, str) else k


def model(core, stage, updates=(2,)):
    out, hit = [], set()
    index = {}
    for row in stage:
        key = (fold(row[0]), row[1])
        if None not in key:
            index.setdefault(key, []).append(row)
    for row in core:
        key = (fold(row[0]), row[1])
        found = index.get(key) if None not in key else None
        if found:
            hit.add(key)
            new = list(row)
            for i in updates:
                new[i] = found[0][i]
            out.append((*new, OLD, NEW))
        else:
            out.append((*row, OLD, OLD))
    for row in stage:
        if (fold(row[0]), row[1]) not in hit:
            out.append((*row, NEW, NEW))
    return sorted(out, key=repr)


def run(spark, core, stage, **how):
    stamped = spark.createDataFrame(core, SCHEMA).select(
        "*",
        F.lit(OLD).cast("timestamp").alias("Create_Dttm"),
        F.lit(OLD).cast("timestamp").alias("Last_Update_Dttm"),
    )
    out = merge_upsert(
        stamped, spark.createDataFrame(stage, SCHEMA), keys=["k1", "k2"], updates=["v"],
        load_ts=NEW, **how,
    )
    assert out.columns == stamped.columns
    rows = out.withColumns({c: F.col(c).cast("string") for c in out.columns[-2:]}).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_model(spark, seed):
    rnd = random.Random(seed)
    spell = [lambda s: s, str.upper, lambda s: s + "  "]
    core_keys = [(f"k{i}", j) for i in range(12) for j in range(2)] + [(None, 1)] * 5
    core = [(k, j, "core", 1) for k, j in core_keys]
    core += [("k7", 0, f"core{i}", i) for i in range(30)]  # one stage row updates them all
    stage = []
    for i in range(6, 18):
        stage.append((rnd.choice(spell)(f"k{i}"), 0, rnd.choice(["new", None]), 2))
    stage += [("hot", 7, f"copy{i}", i) for i in range(40)]
    stage += [(None, 1, "nokey", 3)] * 30 + [("k3", None, "nokey", 4)]
    assert run(spark, core, stage) == model(core, stage)


def test_core_row_hit_twice_is_an_error(spark):
    core = [("a", 1, "x", 1), ("b", 1, "x", 1)]
    stage = [("A", 1, "y", 1), ("a ", 1, "z", 1)]
    with pytest.raises(Exception, match="several stage rows match one core row"):
        run(spark, core, stage)


def test_multi_match_lists_the_keys(spark):
    core = spark.createDataFrame([("a", 1), ("b", 1)], "k1 string, k2 int")
    stage = spark.createDataFrame([("A", 1), ("a ", 1), ("n", 1), ("n", 1)], "k1 string, k2 int")
    assert [tuple(r) for r in multi_match(core, stage, ["k1", "k2"]).collect()] == [("a", 1, 2)]


def test_rerun_changes_nothing_but_the_update_time(spark):
    core = [("a", 1, "x", 1)]
    stage = [("A", 1, "y", 5), ("n", 2, "z", 6)]
    once = run(spark, core, stage)
    again = run(spark, [r[:4] for r in once], stage)
    assert [r[:4] for r in once] == [r[:4] for r in again]


def test_unique_stage_skips_the_check_for_repeats(spark):
    core = [("a", 1, "x", 1)]
    stage = [("A", 1, "y", 5), ("n", 2, "z", 6)]
    assert run(spark, core, stage, unique_stage=True) == model(core, stage)


def plan_of(spark, sf_dir, **how):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    stamp = F.lit(OLD).cast("timestamp")
    core = items.select("*", stamp.alias("Create_Dttm"), stamp.alias("Last_Update_Dttm"))
    out = merge_upsert(
        core, items, keys=["l_orderkey", "l_linenumber"], updates=["l_quantity"], load_ts=NEW,
        nullable_keys=(), unique_stage=True, **how,
    )
    return out._jdf.queryExecution().executedPlan().toString()


def test_small_stage_is_broadcast_and_the_core_not_shuffled(spark, sf_dir):
    (update,) = [x for x in plan_of(spark, sf_dir).split("\n") if "LeftOuter" in x]
    assert "BroadcastHashJoin" in update and "BuildRight" in update


def test_large_stage_is_never_broadcast(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        plan = plan_of(spark, sf_dir)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in plan and "FullOuter" not in plan and "LeftSemi" not in plan
    assert "SortMergeJoin" in plan and "LeftOuter" in plan and "LeftAnti" in plan


def test_hot_core_key_is_split_over_tasks(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = 90_000
        stamp = F.lit(OLD).cast("timestamp")
        key = F.when(F.col("id") % 3 == 0, "Hot").otherwise(F.concat(F.lit("k"), "id"))
        core = spark.range(0, rows, 1, 6).select(
            key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
            stamp.alias("Create_Dttm"), stamp.alias("Last_Update_Dttm"),
        )
        stage = spark.range(0, 30_000, 1, 2).select(
            F.when(F.col("id") == 0, "hot ").otherwise(F.concat(F.lit("K"), "id")).alias("k"),
            F.lit("new").alias("v"),
        )
        out = merge_upsert(core, stage, keys=["k"], updates=["v"], load_ts=NEW)
        total = out.groupBy("v").agg(F.count("*").alias("n"), F.max("k"), F.max("Create_Dttm"))
        counts = {r["v"]: r["n"] for r in total.filter("v = 'new'").collect()}
        summary = out.agg(F.count("*"), F.max("v"), F.max("k"), F.max("Last_Update_Dttm"))
        assert summary.collect()[0][0] == rows + 9_999  # stage numbers divisible by three are new
        assert counts == {"new": rows // 3 + 20_000 + 9_999}
        assert "skew=true" in summary._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_stage_is_shuffled_once(spark):
    """Updates and inserts take the stage from one shuffle, and its keys are not shuffled beside it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    old = "'2023-01-01 00:00:00'"
    try:
        core = spark.range(3000).selectExpr("CASE WHEN id >= 0 THEN concat('K', id, ' ') END AS k", "cast(id AS string) AS v", f"{old} AS Create_Dttm", f"{old} AS Last_Update_Dttm")
        stage = spark.range(2000, 6002).selectExpr("CASE WHEN id < 6000 THEN concat('k', id) END AS k", "concat('n', id) AS v")
        out = merge_upsert(core, stage, keys=["k"], updates=["v"], load_ts="2024-06-01 00:00:00", nullable_keys=())
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The stage, the core and the core's keys.
    assert sum("- Exchange hashpartitioning" in x for x in plan.split("\n")) <= 3 and "ReusedExchange" in plan
    assert len(got) == 6002 and sum(r["k"] is None for r in got) == 2
    rows = {r["k"].strip().lower(): (r["k"], r["v"]) for r in got if r["k"]}
    assert len(rows) == 6000
    for i in range(6000):
        assert rows[f"k{i}"] == (f"K{i} " if i < 3000 else f"k{i}", str(i) if i < 2000 else f"n{i}")
