"""Load jobs end to end, from files to tables."""

import csv

import pytest
from pyspark.sql import functions as F

from feedmill.feeds import FEEDS, UPSERT, feed
from feedmill.plans.loader import (
    FAULT,
    RejectedRows,
    checked,
    input_files,
    load_feed,
    load_prices,
)
from feedmill.sources.delimited import scan
from feedmill.sources.store import TableStore
from feedmill.tables import TABLES

T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"), buckets=4)


def drop(tmp_path, spec, rows, name=None, head=None):
    """Write a drop file; the mask's wildcard becomes a name."""
    folder = tmp_path / "data" / spec.folder
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / (name or spec.mask.replace("*", "x"))
    with open(path, "w", newline="") as f:
        out = csv.writer(f, delimiter=spec.sep, lineterminator="\n")
        for i in range(spec.skip):
            out.writerow(head or [f"head{i}"])
        out.writerows(rows)
    return str(tmp_path / "data")


def sample(spec, i=0, blank=False):
    """A record that fits the feed; with ``blank`` every nullable cell is blanks."""
    row = []
    for c in spec.layout:
        if blank and not c.required:
            text = "" if len(row) % 2 or c.width < 2 else "  "
        elif c.name in spec.dates or c.name.endswith("_Date"):
            text = "2024-01-15"
        elif c.name in spec.times:
            text = "08:30:00"
        elif c.name in spec.numbers:
            text = f"{10 + i}.5"
        elif c.name in ("Inv_Timestamp", "Trans_Timestamp"):
            text = f"2024-01-15 08:30:0{i}"
        elif c.name == "Price_DateTime":
            text = "20240115153000"
        elif c.name == "Price_FutureMonth":
            text = "FGHJ"[i]
        elif c.name == "Price_FutureYear":
            text = "25"
        elif c.name == "Price_Code" and spec.name == "price_platts":
            text = f"PAAAA{i}0H"
        elif c.name == "Price_Code":
            text = f"PAAAA{i}0"
        elif c.width < 3:
            text = "U"[: c.width]
        else:
            text = f"{c.name[: c.width - 1]}{i}"[: c.width]
        row.append(text)
    return row


def needed(spark, store, tmp_path, spec):
    for name in spec.needs:
        dep = feed(name)
        row = sample(dep)
        if name == "container":
            row[dep.columns.index("Container_Desc")] = "TANK0"
        if name == "inventory_dcd":
            row[dep.columns.index("Material")] = "MATERIAL0  "
        load_feed(spark, dep, store, drop(tmp_path, dep, [row]), T1)


def records(spec):
    """Two records; inventory readings share the one tank of the dictionary."""
    rows = [sample(spec, 0), sample(spec, 1)]
    if spec.name == "inventory":
        for r in rows:
            r[0], r[2], r[3] = "Ref_Location0", "Tank0", "Material0"
    return rows


@pytest.mark.parametrize("name", list(FEEDS))
def test_every_feed_loads_and_can_be_rerun(spark, store, tmp_path, name):
    spec = feed(name)
    needed(spark, store, tmp_path, spec)
    branches = {"blend_lab": 16, "blend_pred": 16, "blend_recipe": 10, "price_crack": 3,
                "sensor": 50}.get(name, 1)
    if name == "blend_lab":
        for r in (rows := records(spec)):
            r[spec.columns.index("Container_ID")] = "98"
    else:
        rows = records(spec)
    if name == "price_crack":
        rows = rows[:1]
    data = drop(tmp_path, spec, rows)
    report = load_feed(spark, spec, store, data, T1, archive=False)
    assert (report.scanned, report.rejected) == (len(rows), 0)
    first = store.read(spec.table)
    assert first.schema.names == TABLES[spec.table].schema.names
    assert first.count() == len(rows) * branches
    report = load_feed(spark, spec, store, data, T2, archive=False)
    assert report.written
    again = store.read(spec.table)
    assert again.count() == len(rows) * branches
    data_columns = TABLES[spec.table].data_columns
    assert sorted(map(repr, first.select(*data_columns).collect())) == sorted(
        map(repr, again.select(*data_columns).collect())
    )
    if spec.write in (UPSERT,):
        stamps = again.select(
            F.col("Create_Dttm").cast("string"), F.col("Last_Update_Dttm").cast("string")
        )
        assert {tuple(r) for r in stamps.collect()} == {(T1, T2)}


@pytest.mark.parametrize("name", list(FEEDS))
def test_blanks_become_null_only_where_listed(spark, tmp_path, name):
    spec = feed(name)
    data = drop(tmp_path, spec, [sample(spec, 0, blank=True)])
    rows = checked(scan(spark, spec, input_files(spark, spec, data)), spec)
    (row,) = rows.select(*spec.columns, FAULT).collect()
    assert row[FAULT] is None
    for c in spec.blank_to_null:
        assert row[c] is None, c
    for c in spec.keep_blank:
        assert row[c].strip() == "", c
    for c in spec.required:
        assert row[c] not in (None, ""), c


def test_no_good_row_leaves_the_table_alone(spark, store, tmp_path):
    spec = feed("container")
    data = drop(tmp_path, spec, [sample(spec)])
    load_feed(spark, spec, store, data, T1)
    assert not load_feed(spark, spec, store, drop(tmp_path, spec, []), T2).written
    short = drop(tmp_path, spec, [["short"]])
    assert not load_feed(spark, spec, store, short, T2, on_reject="quarantine").written
    assert not load_feed(spark, spec, store, str(tmp_path / "nothing"), T2).written
    assert store.read("container").count() == 1
    assert store.manifest("container")["version"] == 1


def test_reload_with_a_refused_row_leaves_the_old_version(spark, store, tmp_path):
    spec = feed("container")
    load_feed(spark, spec, store, drop(tmp_path, spec, [sample(spec, i) for i in range(3)]), T1)
    digits = sample(spec, 1)
    digits[spec.columns.index("Min_Op_Qty")] = "3.14159"  # the type would drop a digit
    data = drop(tmp_path, spec, [sample(spec), digits])
    with pytest.raises(RejectedRows):
        load_feed(spark, spec, store, data, T2)
    assert store.read("container").count() == 3 and store.manifest("container")["version"] == 1
    report = load_feed(spark, spec, store, data, T2, on_reject="quarantine")
    assert (report.rejected, store.read("container").count()) == (1, 1)
    found = spark.read.parquet(f"{store.root}/quarantine/container")
    assert {r["reason"] for r in found.collect()} == {"type:Min_Op_Qty"}


def test_quotes_that_no_view_can_place_are_reported(spark, store, tmp_path):
    crack = feed("price_crack")
    good = ["2024-01-02", "70.5", "2024-01-02", "2.1", "2024-01-02", "2.5"]
    rows = [good, [*good[:2], "1/2/2024", *good[3:]]]
    report = load_feed(spark, crack, store, drop(tmp_path, crack, rows), T1)
    assert (report.scanned, report.rejected) == (2, 1)
    platts = feed("price_platts")
    needed(spark, store, tmp_path, platts)
    rows = [["N", f"PAAAA0{c}", "20240115153000", "5"] for c in ("0H", "0O", "0U", "0W")]
    report = load_feed(spark, platts, store, drop(tmp_path, platts, rows), T1)
    assert (report.scanned, report.rejected) == (4, 1)
    reasons = [
        r["reason"]
        for n in ("price_crack", "price_platts")
        for r in spark.read.parquet(f"{store.root}/quarantine/{n}").collect()
    ]
    assert reasons == ["type:Gasoline_Date", "type:Price_Code"]
    rows = store.read("price").filter("Price_Code = 'PAAAA00'").collect()
    assert [(r["Price_High"], r["Price_Index"], r["Price_Volume"]) for r in rows] == [(5, 5, 5)]


def test_bad_rows_go_to_quarantine_with_a_reason(spark, store, tmp_path):
    spec = feed("cost")
    good = ["Loc", "P", "F", "2024-01-15", "8:05", "Fuel", "12.5"]
    rows = [
        good,
        good[:6],
        [*good, "extra"],
        ["L" * 51, *good[1:]],
        [*good[:3], "15.01.2024", *good[4:]],
        [*good[:4], "25:00", *good[5:]],
        [*good[:6], "many"],
    ]
    data = drop(tmp_path, spec, rows)
    report = load_feed(spark, spec, store, data, T1)
    assert (report.scanned, report.rejected) == (7, 6)
    assert load_feed(spark, spec, store, data, T1).rejected == 6  # a rerun sets nothing aside twice
    assert store.read("cost").first()["Cost_Time"] == "08:05:00"
    found = spark.read.parquet(f"{store.root}/quarantine/cost")
    assert sorted(r["reason"] for r in found.collect()) == [
        "malformed", "malformed", "type:Cost_Date", "type:Cost_Time", "type:Cost_Value",
        "width:Ref_Location",
    ]
    with pytest.raises(RejectedRows):
        load_feed(spark, spec, store, data, T2, on_reject="fail")
    assert store.manifest("cost")["version"] == 2


def test_quoted_line_ends_are_loaded_whole(spark, store, tmp_path):
    spec = feed("movements")
    row = sample(spec)
    row[-1] = 'first line\nsecond, with "quotes"'
    data = drop(tmp_path, spec, [row, sample(spec, 1)])
    report = load_feed(spark, spec, store, data, T1)
    assert (report.scanned, report.rejected) == (2, 0)
    assert row[-1] in {r["Comments"] for r in store.read("movements").collect()}


def test_several_files_in_any_case_of_the_mask(spark, store, tmp_path):
    spec = feed("liftings")
    drop(tmp_path, spec, [sample(spec, 0)], "LIFTINGS_a.CSV")
    data = drop(tmp_path, spec, [sample(spec, 1)], "liftings_b.csv")
    drop(tmp_path, spec, [sample(spec, 2)], "other.csv")
    short = sample(spec, 3)[:4]
    drop(tmp_path, spec, [short, sample(spec, 4)], "liftings c+%.csv")
    drop(tmp_path, spec, [], "liftings_d.csv")
    assert len(load_feed(spark, spec, store, data, T1).files) == 4
    assert store.read("liftings").count() == 3
    counts = spark.read.parquet(f"{store.root}/audit/liftings").select("file", "skipped", "records", "refused")
    assert sorted(map(tuple, counts.collect())) == [
        ("LIFTINGS_a.CSV", 1, 1, 0), ("liftings c+%.csv", 1, 2, 1), ("liftings_b.csv", 1, 1, 0), ("liftings_d.csv", 1, 0, 0),
    ]


def test_upsert_touches_only_the_days_in_the_file(spark, store, tmp_path):
    spec = feed("safety")

    def row(day, value):
        return ["Loc", day, "08:00:00", "Actual", "Injuries", value]

    load_feed(spark, spec, store, drop(tmp_path, spec, [row("2024-01-01", "1"), row("2024-01-02", "2")]), T1)  # noqa: E501
    before = store.manifest("safety")["slices"]
    load_feed(spark, spec, store, drop(tmp_path, spec, [row("2024-01-02", ""), row("2024-01-03", "3")]), T2)  # noqa: E501
    after = store.manifest("safety")["slices"]
    assert after["2024-01-01"] == before["2024-01-01"]
    assert after["2024-01-02"] != before["2024-01-02"]
    values = {str(r["Safety_Date"]): r["Safety_Value"] for r in store.read("safety").collect()}
    assert values["2024-01-02"] is None and len(values) == 3


def test_two_rows_for_one_core_row(spark, store, tmp_path):
    spec = feed("blend")
    load_feed(spark, spec, store, drop(tmp_path, spec, [sample(spec)]), T1)
    twice = drop(tmp_path, spec, [sample(spec), sample(spec), sample(spec, 1), sample(spec, 1)])
    with pytest.raises(Exception, match="several stage rows"):
        load_feed(spark, spec, store, twice, T2)
    assert store.manifest("blend")["version"] == 1
    report = load_feed(spark, spec, store, twice, T2, on_multi_match="quarantine")
    assert report.conflicting == 2
    assert store.read("blend").count() == 3  # repeats that match nothing are all inserted


def test_blend_lab_replaces_its_containers_and_appends_everything(spark, store, tmp_path):
    lab, blend_lab = feed("lab"), feed("blend_lab")
    rows = []
    for i, container in enumerate(["96", "97", "101", "102", "T9", ""]):
        row = sample(lab, 0)
        row[1], row[6] = f"S{i}", container
        rows.append(row)
    load_feed(spark, lab, store, drop(tmp_path, lab, rows), T1)
    new = sample(blend_lab)
    new[5] = "500"
    data = drop(tmp_path, blend_lab, [new])
    load_feed(spark, blend_lab, store, data, T2)
    kept = store.read("lab").filter("Sample_ID like 'S_'").collect()
    assert {r["Container_ID"] for r in kept} == {"96", "102", "T9", None}
    assert store.read("lab").filter("Container_ID = '500'").count() == 16
    load_feed(spark, blend_lab, store, data, T2)  # outside the scope: a rerun repeats it
    assert store.read("lab").filter("Container_ID = '500'").count() == 32


def test_unmapped_readings_are_dropped(spark, store, tmp_path):
    spec = feed("inventory")
    needed(spark, store, tmp_path, spec)
    rows = [*records(spec), *records(spec)]
    rows[2][2], rows[3][3] = "nowhere", " "
    report = load_feed(spark, spec, store, drop(tmp_path, spec, rows), T1)
    assert report.scanned == 4 and store.read("inventory").count() == 2
    lost = spark.read.parquet(f"{store.root}/quarantine/inventory").collect()
    assert report.unmapped == 2
    assert sorted(r["reason"] for r in lost) == ["unmapped:container", "unmapped:material"]
    row = store.read("inventory").first()
    assert (row["Container_ID"], row["Material_ID"]) == ("Container_ID0", "Material_ID0")


def test_price_update_leaves_open_and_volume(spark, store, tmp_path):
    spec = feed("price_futures")

    def row(price):
        return ["CL", "F", "25", "2024-01-15", price, price, price, price, price, "9"]

    load_feed(spark, spec, store, drop(tmp_path, spec, [row("70")]), T1)
    load_feed(spark, spec, store, drop(tmp_path, spec, [row("80")]), T2)
    (r,) = store.read("price").collect()
    assert (r["Price_Close"], r["Price_Low"], r["Price_High"]) == (80, 80, 80)
    assert (r["Price_Open"], r["Price_Volume"]) == (70, 70)
    assert (r["Price_Code"], r["Price_Description"]) == ("CLF25", "CL futures Jan 2025")


def test_all_price_feeds_in_one_commit(spark, store, tmp_path):
    specs = [feed(n) for n in ("price_crack", "price_futures", "price_opisfeed", "price_opisspot",
                               "price_platts")]
    needed(spark, store, tmp_path, feed("price_platts"))
    for spec in specs:
        data = drop(tmp_path, spec, [sample(spec)])
    reports = load_prices(spark, specs, store, data, T1)
    assert {r.version for r in reports} == {1}
    counts = {r["Price_Source"]: r["count"] for r in store.read("price").groupBy("Price_Source").count().collect()}  # noqa: E501
    assert counts == {"CRACK": 3, "FUTURES": 1, "OPIS": 2, "PLATTS": 1}


def test_sensor_files_are_archived_after_the_load(spark, store, tmp_path):
    spec = feed("sensor")
    data = drop(tmp_path, spec, [sample(spec)], "a.csv")
    (tmp_path / "data" / "Tags" / "Archive").mkdir()
    (tmp_path / "data" / "Tags" / "Archive" / "a.csv").write_text("older")
    report = load_feed(spark, spec, store, data, T1)
    assert report.archived == 1
    assert not (tmp_path / "data" / "Tags" / "a.csv").exists()
    assert (tmp_path / "data" / "Tags" / "Archive" / "a.csv").read_text() != "older"
    daily = store.read("sensor_daily")
    assert daily.count() == 50 and daily.first()["Readings"] == 1


def test_failed_sensor_load_archives_nothing(spark, store, tmp_path, monkeypatch):
    import feedmill.plans.loader as loader

    def fail(*_a, **_k):
        raise RuntimeError("no")

    monkeypatch.setattr(loader, "load_sensor_readings", fail)
    spec = feed("sensor")
    data = drop(tmp_path, spec, [sample(spec)], "a.csv")
    with pytest.raises(RuntimeError):
        load_feed(spark, spec, store, data, T1)
    assert (tmp_path / "data" / "Tags" / "a.csv").exists()


def test_expired_versions_are_deleted_and_the_current_one_stays(spark, store, tmp_path):
    spec = feed("container")
    data = drop(tmp_path, spec, [sample(spec, 0), sample(spec, 1)])
    for _ in range(3):
        load_feed(spark, spec, store, data, T1)
    assert store.expire("container", keep=1) == 2
    assert store.read("container").count() == 2
    assert load_feed(spark, spec, store, data, T2).version == 4


def test_two_writers_cannot_publish_one_version(spark, store, tmp_path, monkeypatch):
    spec = feed("container")
    load_feed(spark, spec, store, drop(tmp_path, spec, [sample(spec)]), T1)
    before = store.manifest("container")
    rows = store.read("container")
    store.overwrite("container", rows)
    monkeypatch.setattr(store, "manifest", lambda _name: before)
    with pytest.raises(FileExistsError):
        store.overwrite("container", rows)


def test_failed_write_leaves_the_old_version(spark, store, tmp_path):
    spec = feed("container")
    load_feed(spark, spec, store, drop(tmp_path, spec, [sample(spec)]), T1)
    broken = store.read("container").withColumn(
        "Units", F.raise_error(F.lit("lost")).cast("string")
    )
    with pytest.raises(Exception, match="lost"):
        store.overwrite("container", broken)
    assert store.read("container").first()["Units"] == "Units0"


def liftings(numbers, **cells):
    spec = feed("liftings")
    rows = []
    for i in numbers:
        row = sample(spec)
        row[spec.columns.index("BOL_Number")] = f"B{i:06d}"
        for name, text in cells.items():
            row[spec.columns.index(name)] = text
        rows.append(row)
    return rows


def test_upsert_rewrites_only_slices_with_a_match(spark, store, tmp_path):
    spec = feed("liftings")
    load_feed(spark, spec, store, drop(tmp_path, spec, liftings(range(200))), T1)
    before = store.parts("liftings")
    assert len(before) == 4 and all(len(c) == 1 for c in before.values())
    load_feed(spark, spec, store, drop(tmp_path, spec, liftings(range(200, 500))), T2)
    after = store.parts("liftings")
    # 300 new rows: every slice keeps its file and gets a further one.
    assert all(after[s][:1] == before[s] and len(after[s]) == 2 for s in before)
    load_feed(spark, spec, store, drop(tmp_path, spec, liftings([7], Driver="Corrected")), T2)
    last = store.parts("liftings")
    changed = [s for s in last if last[s] != after[s]]
    assert len(changed) == 1 and len(last[changed[0]]) == 1
    rows = store.read("liftings")
    assert rows.count() == 500
    assert [r["BOL_Number"] for r in rows.filter("Driver = 'Corrected'").collect()] == ["B000007"]
    # The same with a new row beside the correction, which goes to its own slice.
    load_feed(spark, spec, store, drop(tmp_path, spec, liftings([7, 999], Driver="Again")), T2)
    assert {r["BOL_Number"] for r in store.read("liftings").filter("Driver = 'Again'").collect()} == {"B000007", "B000999"}
    assert store.read("liftings").count() == 501


def test_slices_of_many_commits_are_put_together(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr("feedmill.plans.loader.MOST_PARTS", 2)
    spec = feed("liftings")
    for k in range(4):
        load_feed(spark, spec, store, drop(tmp_path, spec, liftings(range(100 * k, 100 * k + 100))), T1)
        assert all(len(c) <= 2 for c in store.parts("liftings").values())
    assert store.read("liftings").count() == 400


def test_key_filter_loses_no_key(spark):
    from feedmill.operators.keyfilter import key_filter, might_hold

    keys = spark.range(0, 3000, 3).select(F.xxhash64("id").alias("h"))
    rows = spark.range(30000).select("id", F.xxhash64("id").alias("h"))
    passed = {r[0] for r in rows.filter(might_hold(key_filter(keys, 1000), 1000, F.col("h"))).select("id").collect()}
    assert set(range(0, 3000, 3)) <= passed
    assert len(passed) < 1000 + 0.05 * 29000
    none = rows.filter(might_hold(key_filter(keys.limit(0), 0), 0, F.col("h")))
    assert none.count() == 0
