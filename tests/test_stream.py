"""Drop-folder ingestion of sensor files."""

import pytest
from pyspark.sql import functions as F

from feedmill.feeds import TAG_PAIRS
from feedmill.sources.store import TableStore
from feedmill.streaming.sensor_drop import ingest_sensor_drop


def wide(stamp, *pairs, location="Site"):
    cells = [stamp, location]
    for tag, value in pairs:
        cells += [tag, value]
    cells += ["", ""] * (TAG_PAIRS - len(pairs))
    return ",".join(cells) + "\n"


HEAD = "".join(f"head{i}\n" for i in range(4))


@pytest.fixture
def run(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    folder = tmp_path / "Tags"
    folder.mkdir()

    def go(load_ts, **options):
        q = ingest_sensor_drop(
            spark, store, str(folder), str(tmp_path / "checkpoint"), clock=lambda: load_ts,
            archive_dir=str(tmp_path / "done"), **options,
        )
        q.awaitTermination()
        if q.exception():
            raise q.exception()

    return store, folder, go


def values(store):
    rows = store.read("sensor").collect()
    return {(r["Tag_ID"], str(r["Trans_Timestamp"])): r["Tag_Value"] for r in rows}


def test_two_runs_with_late_and_corrected_readings(spark, run):
    store, folder, go = run
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        body = "".join(wide(f"2024-01-01 00:{i:02d}:00", ("T1", str(i)), ("T2", "on")) for i in range(60))  # noqa: E501
        (folder / "a.csv").write_text(HEAD + body)
        (folder / "b.csv").write_text(HEAD + wide("2024-01-02 00:00:00", ("T1", "5"), ("", "9")))
        go("2024-02-01 00:00:00")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(values(store)) == 121
    daily = {
        (r["Tag_ID"], str(r["Reading_Date"])): r for r in store.read("sensor_daily").collect()
    }
    assert daily["T1", "2024-01-01"]["Avg_Value"] == 29.5
    assert daily["T1", "2024-01-01"]["Last_Value"] == 59
    assert daily["T2", "2024-01-01"]["Readings"] == 60
    assert daily["T2", "2024-01-01"]["Avg_Value"] is None
    untouched = store.manifest("sensor")["slices"]["2024-01-02"]

    (folder / "c.CSV").write_text(
        HEAD
        + wide("2024-01-01 00:59:00", ("t1", "100"))
        + wide("2024-01-01 00:59:00", ("T1", "159"))
        + wide("2023-12-31 23:00:00", ("T1", "1"))
        + "bad,row\n"
    )
    go("2024-02-02 00:00:00")
    after = values(store)
    assert len(after) == 122
    assert after["T1", "2024-01-01 00:59:00"] == "159"
    assert store.manifest("sensor")["slices"]["2024-01-02"] == untouched
    last = store.read("sensor_daily", ["2024-01-01"]).filter("Tag_ID = 'T1'").first()
    assert last["Last_Value"] == 159 and last["Readings"] == 60
    (refused,) = spark.read.parquet(f"{store.root}/quarantine/sensor").collect()
    assert (refused["_raw"], refused["reason"]) == ("bad,row", "malformed")

    version = store.manifest("sensor")["version"]
    go("2024-02-03 00:00:00")  # nothing new: nothing is written
    assert store.manifest("sensor")["version"] == version


def test_files_one_by_one(run):
    store, folder, go = run
    for i in range(3):
        (folder / f"f{i}.csv").write_text(HEAD + wide(f"2024-01-0{i + 1} 00:00:00", ("T", str(i))))
    go("2024-02-01 00:00:00", max_files=1)
    assert store.manifest("sensor")["version"] == 3 and len(values(store)) == 3


def test_times_are_the_plants_own(spark, run):
    store, folder, go = run
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        times = ("02:30", "03:30", "23:30")  # the first is skipped there by summer time
        body = "".join(wide(f"2024-03-10 {t}:00", ("T", t[:2])) for t in times)
        (folder / "a.csv").write_text(HEAD + body)
        go("2024-04-01 00:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    (folder / "b.csv").write_text(HEAD + wide("2024-03-10 23:30:00", ("T", "new")))
    go("2024-04-02 00:00:00")
    want = {"02:30": "02", "03:30": "03", "23:30": "new"}
    assert values(store) == {("T", f"2024-03-10 {t}:00"): v for t, v in want.items()}
    assert list(store.manifest("sensor")["slices"]) == ["2024-03-10"]


def daily(rows):
    return sorted((r["Ref_Location"], r["Tag_ID"], str(r["Reading_Date"]), r["Readings"], r["Min_Value"], r["Max_Value"], r["Avg_Value"], r["Last_Value"]) for r in rows)


def test_daily_states_follow_every_change(spark, tmp_path):
    """New, corrected, repeated and lost values, in several spellings: always what a full computation gives."""
    import random
    from datetime import datetime, timedelta

    from feedmill.operators.summary import daily_summary
    from feedmill.plans.loader import load_sensor_readings

    store, rnd = TableStore(spark, str(tmp_path / "tables")), random.Random(3)
    schema = "Ref_Location string, Tag_ID string, Trans_Timestamp timestamp_ntz, Tag_Value string"
    for batch in range(3):
        rows = {}
        for _ in range(40):
            tag, at = rnd.choice("AB"), datetime(2024, 1, rnd.randint(1, 2)) + timedelta(hours=rnd.randint(0, 9))
            rows[tag, at] = (rnd.choice(["Site", "SITE "]), rnd.choice([tag, tag.lower() + " "]), at, rnd.choice(["1", "2.5", "-3", "off", "7"]))
        load_sensor_readings(store, spark.createDataFrame(list(rows.values()), schema), f"2024-02-0{batch + 1} 00:00:00")
        want = daily_summary(store.read("sensor"), ("Ref_Location", "Tag_ID"), "Trans_Timestamp", "Tag_Value")
        assert daily(store.read("sensor_daily").collect()) == daily(want.collect())
    versions = [store.manifest(n)["version"] for n in ("sensor", "sensor_daily")]
    load_sensor_readings(store, spark.createDataFrame(list(rows.values()), schema), "2024-03-01 00:00:00")
    assert versions == [store.manifest(n)["version"] for n in ("sensor", "sensor_daily")]  # a replay changes nothing


def test_states_lost_between_two_commits_are_computed_anew(spark, tmp_path, monkeypatch):
    import feedmill.plans.loader as loader

    store = TableStore(spark, str(tmp_path / "tables"))
    schema = "Ref_Location string, Tag_ID string, Trans_Timestamp string, Tag_Value string"

    def load(*values):
        rows = [("S", "T", f"2024-01-01 00:0{i}:00", v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, schema).withColumn("Trans_Timestamp", F.col("Trans_Timestamp").cast("timestamp_ntz"))
        loader.load_sensor_readings(store, df, "2024-02-01 00:00:00")

    load("1", "2")
    with monkeypatch.context() as m:
        m.setattr(loader, "_write_states", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load("1", "2", "9")
    assert store.read("sensor_daily").first()["Max_Value"] == 2
    load("1", "2", "9")
    assert store.read("sensor_daily").first()["Max_Value"] == 9


def test_one_file_a_batch_does_not_rewrite_the_day_each_time(spark, run):
    store, folder, go = run
    for i in range(4):
        (folder / f"{i}.csv").write_text(HEAD + wide(f"2024-01-01 00:0{i}:00", ("T1", str(i))))
    go("2024-02-01 00:00:00", max_files=1)
    # Every batch is new: four further files, and the first one is as it was.
    assert len(store.parts("sensor")["2024-01-01"]) == 4
    assert store.read("sensor_daily").first()["Readings"] == 4


def test_records_over_line_ends_in_the_stream(spark, run):
    store, folder, go = run
    (folder / "a.csv").write_text(HEAD + wide("2024-01-01 00:00:00", ("T1", '"1\n"'), ("T2", "2")) + wide("2024-01-01 00:01:00", ("T1", "3")))
    go("2024-02-01 00:00:00")
    assert values(store) == {("T1", "2024-01-01 00:00:00"): "1\n", ("T2", "2024-01-01 00:00:00"): "2", ("T1", "2024-01-01 00:01:00"): "3"}
