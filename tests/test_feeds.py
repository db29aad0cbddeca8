"""The declared feeds hold what the input files and core tables prescribe."""

from feedmill.feeds import FEEDS, RELOAD, REPLACE, SENSOR, UPSERT
from feedmill.tables import TABLES

WIDTHS = {
    "blend_lab": 38, "blend": 7, "blend_pred": 20, "blend_recipe": 14, "caldate": 3,
    "container": 9, "costforensics": 9, "cost": 7, "inventory_dcd": 3, "inventory": 12,
    "lab_comp_group": 3, "lab_comp": 4, "lab": 26, "liftings": 25, "marketprice": 5,
    "material_hier_group": 2, "material_hier": 9, "material": 5, "movements": 13,
    "optthruput_weights": 8, "price_crack": 6, "price_futures": 10, "price_opisfeed": 10,
    "price_opisspot": 11, "price_platts_dcd": 16, "price_platts": 4, "safety": 6,
    "sensor_descunits": 4, "sensor": 102, "sensor_loadparams": 52, "tag_container_xref": 3,
    "unit": 7,
}


def test_all_feeds_with_their_column_counts():
    assert {n: len(s.layout) for n, s in FEEDS.items()} == WIDTHS


def test_write_modes():
    count = {m: sum(s.write == m for s in FEEDS.values()) for m in (RELOAD, UPSERT, REPLACE, SENSOR)}
    assert count == {RELOAD: 17, UPSERT: 13, REPLACE: 1, SENSOR: 1}


def test_skips_and_separators():
    other = {n: s.skip for n, s in FEEDS.items() if s.skip != 1}
    assert other == {
        "price_opisfeed": 0, "price_opisspot": 0, "price_crack": 2, "price_platts_dcd": 2,
        "price_platts": 2, "sensor": 4, "sensor_descunits": 5,
    }
    assert [n for n, s in FEEDS.items() if s.sep == " "] == ["price_platts"]


def test_columns_that_keep_their_blanks():
    kept = {n: s.keep_blank for n, s in FEEDS.items() if s.keep_blank and n != "sensor"}
    assert kept == {
        "costforensics": ("CF_Date",),
        "inventory": ("Gauge",),
        "liftings": ("BOL_Product",),
        "price_opisfeed": ("Price_Col1",),
        "price_opisspot": ("Price_Col1", "Price_Close"),
        "price_platts": ("Price_Col1",),
        "sensor_loadparams": ("Extract_Group", "Ref_Location"),
    }
    assert FEEDS["sensor"].blank_to_null == []
    assert FEEDS["inventory_dcd"].blank_to_null == []
    assert len(FEEDS["sensor_loadparams"].blank_to_null) == 50


def test_audit_columns():
    odd = {n: len(s.audit) for n, s in FEEDS.items() if len(s.audit) != 2}
    assert odd == {"caldate": 0, "price_platts_dcd": 0, "sensor_loadparams": 0, "sensor_descunits": 1}


def test_upserts_name_core_columns_and_leave_keys_alone():
    for s in FEEDS.values():
        if s.write == UPSERT:
            core = set(TABLES[s.table].columns)
            assert set(s.keys) <= core and set(s.updates) <= core
            assert not set(s.keys) & set(s.updates)


def test_only_price_upserts_are_partial():
    for s in FEEDS.values():
        if s.write == UPSERT:
            rest = set(TABLES[s.table].columns) - set(s.keys) - set(s.updates)
            assert bool(rest) == (s.table == "price")


def test_core_tables():
    assert len(TABLES) == 28  # the 27 targets and the maintained daily summary
    assert len(TABLES["price"].columns) == 19
    assert len(TABLES["inventory"].columns) == 17
    assert len(TABLES["lab"].columns) == 26
