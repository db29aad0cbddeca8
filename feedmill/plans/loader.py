"""Load jobs: scan, check, land, shape, write.

Every job reads its files once, lands the checked rows as Parquet in a folder all
executors share, and works from there: later steps read only the columns they
need, and losing an executor costs no re-read of the drop files.
"""

from __future__ import annotations

import fnmatch
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.feeds import RELOAD, REPLACE, SENSOR, UPDATED, FeedSpec, feed
from feedmill.functions.typing import (
    compact_day,
    load_stamp,
    stamp_clock,
    stamp_day,
    to_clock,
    to_day,
    exact_number,
    to_stamp,
)
from feedmill.operators.normalise import normalise, with_audit
from feedmill.operators.quality import row_fault
from feedmill.operators.replace import reload, replace_where
from feedmill.operators.summary import STALE, STATE, average, daily_states, merge_states
from feedmill.operators.upsert import (
    fresh_rows,
    merge_upsert,
    multi_match,
    present_keys,
    repeated_keys,
    split_join,
    with_keys,
    with_match_keys,
    without_keys,
)
from feedmill.plans import plant, prices
from feedmill.sources import files
from feedmill.sources.delimited import (
    ARRIVAL,
    BLOCK,
    BLOCK_END,
    FILE,
    MALFORMED,
    PIECE,
    RAW,
    ROW,
    from_pieces,
    scan_lines,
)
from feedmill.sources.store import SLICE, TableStore
from feedmill.tables import table

FAULT = "_fault"
#: Commits that a slice may be spread over before it is put together again.
MOST_PARTS = 16


class RejectedRows(Exception):
    """Rows were refused and the job was told not to go on without them."""


@dataclass
class LoadReport:
    feed: str
    files: list[str] = field(default_factory=list)
    scanned: int = 0
    rejected: int = 0
    conflicting: int = 0
    unmapped: int = 0
    version: int | None = None
    archived: int = 0

    @property
    def written(self) -> bool:
        return self.version is not None


@dataclass
class Landed:
    spec: FeedSpec
    path: str
    report: LoadReport
    rows: DataFrame | None


# --------------------------------------------------------------------------
# Landing
# --------------------------------------------------------------------------

_STAMPS: dict[str, dict[str, Callable[[Column], Column]]] = {
    "inventory": {"Inv_Timestamp": lambda c: F.when(stamp_clock(c).isNotNull(), stamp_day(c))},
    "sensor": {"Trans_Timestamp": to_stamp},
    "price_platts": {
        "Price_DateTime": compact_day,
        "Price_Code": lambda c: F.when(prices.known_kind(c), c),
    },
    # A blank date is a series without a quote.
    "price_crack": {
        f"{series}_Date": lambda c: F.when(F.trim(c) == "", F.lit("")).otherwise(
            to_day(c).cast("string")
        )
        for series in prices.CRACK_SERIES
    },
}


def typed_forms(spec: FeedSpec) -> dict[str, Column]:
    """Landed columns that have to read as a number, date or time."""
    forms = {c: exact_number(F.col(c)) for c in spec.numbers}
    forms |= {c: to_day(F.col(c)) for c in spec.dates}
    forms |= {c: to_clock(F.col(c)) for c in spec.times}
    forms |= {c: f(F.col(c)) for c, f in _STAMPS.get(spec.name, {}).items()}
    return forms


def checked(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """Scanned rows with blanks as NULL and the first reason to refuse each."""
    fault = row_fault(spec.required, spec.widths, typed_forms(spec), F.col(MALFORMED))
    return normalise(rows, spec.blank_to_null).withColumn(FAULT, fault)


def work_folder(spark: SparkSession, store: TableStore) -> str:
    """The shared folder the cluster names, or one beside the tables."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return files.join(shared, "feedmill") if shared else files.join(store.root, "_work")


def input_files(spark: SparkSession, spec: FeedSpec, data_dir: str) -> list[str]:
    """Files directly in the feed's folder whose name fits the mask, in any case."""
    folder = files.join(data_dir, spec.folder)
    names = files.names_in(spark, folder)
    mask = spec.mask.lower()
    return [files.join(folder, n) for n in names if fnmatch.fnmatchcase(n.lower(), mask)]


GOOD, REFUSED, PIECES = "good", "refused", "piece"
OUTCOME = "_outcome"


def write_landing(rows: DataFrame, spec: FeedSpec, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Land checked rows by state; what the pieces of spanning records make is added from there.

    ``rows`` are checked, numbered lines. Raw text is kept of refused rows and of pieces.
    """
    order = [ARRIVAL, ROW] if spec.write == SENSOR else []
    counts = {"scanned": 0, "rejected": 0, "pieces": 0}

    def write(some: DataFrame) -> DataFrame:
        seen = Observation()
        piece, refuse = F.col(PIECE) != 0, F.col(FAULT).isNotNull()
        state = F.when(piece, PIECES).when(refuse, REFUSED).otherwise(GOOD)
        kept = some.withColumn(OUTCOME, state).withColumn(RAW, F.when(state != GOOD, F.col(RAW)))
        located = [F.when(piece, F.col(c)).alias(c) for c in (ARRIVAL, ROW) if c not in order]
        kept = kept.select(*spec.columns, *order, *located, RAW, FILE, BLOCK, BLOCK_END, PIECE, FAULT, OUTCOME)
        kept.observe(
            seen,
            F.count_if(~piece).alias("scanned"),
            F.count_if(~piece & refuse).alias("rejected"),
            F.count_if(piece).alias("pieces"),
        ).write.partitionBy(OUTCOME).mode("append").parquet(path)
        # Without any row there are no metrics at all.
        for name in counts:
            counts[name] += seen.get.get(name) or 0
        return kept

    landed = landing(rows.sparkSession, write(rows), path)
    if counts["pieces"]:
        write(checked(from_pieces(landed.filter(F.col(OUTCOME) == PIECES), spec), spec))
        landed = rows.sparkSession.read.schema(landed.schema).parquet(path)
    return landed, counts


def landing(spark: SparkSession, kept: DataFrame, path: str) -> DataFrame:
    """Landed rows; the state is the folder they are in."""
    return spark.read.schema(kept.schema).parquet(path)


def land(
    spark: SparkSession, spec: FeedSpec, store: TableStore, paths: Sequence[str], load: str
) -> Landed:
    """Scan files once into checked Parquet. What an earlier run of the same load set aside goes first."""
    report = LoadReport(spec.name, list(paths))
    base = files.join(work_folder(spark, store), f"{spec.name}-{uuid.uuid4().hex}")
    if not paths:
        return Landed(spec, base, report, None)
    files.delete_tree(spark, _set_aside(store, spec, load))
    try:
        rows = _landed_rows(spark, spec, store, report, base, load)
    except BaseException:
        files.delete_tree(spark, base)
        raise
    return Landed(spec, base, report, rows)


def _landed_rows(
    spark: SparkSession, spec: FeedSpec, store: TableStore, report: LoadReport, base: str, load: str
) -> DataFrame | None:
    rows = checked(scan_lines(spark, spec, report.files), spec)
    landed, counts = write_landing(rows, spec, files.join(base, "stage"))
    report.scanned, report.rejected = counts["scanned"], counts["rejected"]
    count_files(store, spec, landed, report.files, load)
    if report.rejected:
        quarantine(store, spec, refused(landed), load, "refused")
    return good_rows(landed) if report.scanned > report.rejected else None


def count_files(
    store: TableStore, spec: FeedSpec, landed: DataFrame, paths: Sequence[str], load: str
) -> DataFrame:
    """One row per file of a load: head records skipped, records and refused ones; written beside the tables.

    Counted from what was landed, of which only the file names and outcomes are read. A file without a record has a row too.
    """
    name = F.element_at(F.split(F.url_decode(F.replace(FILE, F.lit("+"), F.lit("%2B"))), "/"), -1)
    counts = landed.filter(F.col(OUTCOME) != PIECES).groupBy(name.alias("file"))
    counts = counts.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col(OUTCOME) == REFUSED).alias("refused")
    )
    listed = store.spark.createDataFrame([(p.rsplit("/", 1)[1],) for p in paths], "file string")
    rows = listed.join(counts, "file", "left").select(
        "file", F.lit(spec.skip).alias("skipped"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("records", "refused")]
    )
    path = files.join(store.root, "audit", spec.name, f"load={load}")
    rows.write.mode("overwrite").parquet(path)
    return store.spark.read.parquet(path)


def good_rows(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col(OUTCOME) == GOOD)


def refused(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col(OUTCOME) == REFUSED).select(RAW, FILE, F.col(FAULT).alias("reason"))


def load_id(load_ts) -> str:
    """A load's name in quarantine: its time, as a folder name."""
    return re.sub(r"[^0-9A-Za-z.-]+", "_", str(load_ts))


def _set_aside(store: TableStore, spec: FeedSpec, load: str) -> str:
    return files.join(store.root, "quarantine", spec.name, f"load={load}")


def quarantine(store: TableStore, spec: FeedSpec, rows: DataFrame, load: str, step: str) -> None:
    """Set rows aside in a folder per load and step: a rerun replaces what it set aside before."""
    path = files.join(_set_aside(store, spec, load), f"step={step}")
    rows.write.mode("overwrite").parquet(path)


# --------------------------------------------------------------------------
# Shaping
# --------------------------------------------------------------------------


def shaped(landed: Landed, store: TableStore) -> DataFrame:
    """Landed rows as typed rows of the target table, without audit columns."""
    spec, rows = landed.spec, landed.rows
    match spec.name:
        case "blend_lab":
            return plant.blend_lab_rows(rows)
        case "blend_pred":
            return plant.blend_pred_rows(rows)
        case "blend_recipe":
            return plant.blend_recipe_rows(rows)
        case "inventory":
            return plant.inventory_rows(rows, store.read("container"), store.read("inventory_dcd"))
        case "sensor":
            return plant.sensor_readings(rows, (ARRIVAL, ROW))
        case "price_crack":
            return prices.crack_view(rows)
        case "price_futures":
            return prices.futures_view(rows)
        case "price_opisfeed":
            return prices.opis_feedstock_view(rows)
        case "price_opisspot":
            return prices.opis_spot_view(rows)
        case "price_platts":
            return prices.platts_view(rows, store.read("price_platts_dcd"))
        case _:
            return plant.typed_rows(rows, spec)


def settled(spark: SparkSession, rows: DataFrame, base: str) -> DataFrame:
    """Rows written and read back: joined or grouped once, with a known size."""
    path = files.join(base, "shaped")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


# --------------------------------------------------------------------------
# Writing
# --------------------------------------------------------------------------


def upsert(
    store: TableStore,
    name: str,
    stage: DataFrame,
    *,
    keys: Sequence[str],
    updates: Sequence[str],
    load_ts,
    nullable_keys: Sequence[str] = (),
    unique_stage: bool = False,
    found: DataFrame | None = None,
    note=None,
) -> tuple[int, list[str]]:
    """Upsert a settled stage; gives the version and the slices that the stage belongs to.

    Only slices that hold a key of the stage are read whole and rewritten. Rows that are new are added to their
    slices as further files; a slice of ``MOST_PARTS`` commits is put together when rows are added to it. ``found``
    names the slices and compared keys that are held already, where the caller has looked them up.
    """
    spark, core = store.spark, table(name)
    touched = store.slices_in(name, stage)
    base = files.join(work_folder(spark, store), f"{name}-keys-{uuid.uuid4().hex}")
    stage = stage.select(*[F.col(c).cast(core.schema[c].dataType).alias(c) for c in core.data_columns])
    if found is None:
        held = store.read(name, touched, with_slice=True)
        found = settled(spark, present_keys(held, stage, keys, SLICE), base)
    try:
        matched = {r[0] for r in found.select(SLICE).distinct().collect()}
        present = found.drop(SLICE).distinct()
        present = present.withColumnsRenamed(dict(zip(present.columns, keys)))
        changes, news = with_keys(stage, present, keys), without_keys(stage, present, keys)
        # One pass over the changes' keys: without repeats they take a single join.
        unique_stage = unique_stage or repeated_keys(changes, keys).isEmpty()
        full = {s for s, parts in store.parts(name).items() if s in set(touched) and len(parts) >= MOST_PARTS}
        merged = merge_upsert(
            store.read(name, matched | full),
            changes,
            keys=keys,
            updates=updates,
            load_ts=load_ts,
            audit=core.audit,
            nullable_keys=nullable_keys,
            unique_stage=unique_stage,
            insert=False,
        )
        rows = merged.unionByName(fresh_rows(news, core.schema.names, load_ts, core.audit))
        return store.add(name, rows, matched | full, note), touched
    finally:
        files.delete_tree(spark, base)


def replace_blend_lab(store: TableStore, rows: DataFrame, load_ts) -> int:
    """Drop the blend containers' lab rows and append the new ones: slices without such rows are not rewritten."""
    scope = plant.blend_lab_scope()
    scoped = store.read("lab", with_slice=True).filter(scope).select(SLICE).distinct()
    touched = {r[0] for r in scoped.collect()}
    after = replace_where(store.read("lab", touched), scope, with_audit(rows, load_ts))
    return store.add("lab", after, touched)


DAILY_KEYS = ("Ref_Location", "Tag_ID", "Reading_Date")


def _states_of(readings: DataFrame, value: str = "Tag_Value") -> DataFrame:
    return daily_states(readings, DAILY_KEYS[:2], "Trans_Timestamp", value)


def _write_states(store: TableStore, states: DataFrame, days: Sequence[str], load_ts) -> int:
    """Publish the days' states, noting the version of the readings they are of."""
    rows = states.withColumn("Avg_Value", average()).withColumn(UPDATED, load_stamp(load_ts))
    note = {"of": store.manifest("sensor")["version"]}
    return store.add("sensor_daily", rows, days, note=note)


def refresh_sensor_daily(store: TableStore, days: Sequence[str], load_ts) -> int:
    """Compute the daily states of the given days anew from the sensor table."""
    return _write_states(store, _states_of(store.read("sensor", days)), days, load_ts)


def catch_up_sensor_daily(store: TableStore, load_ts) -> None:
    """Compute anew the days of loads that ended before their states were written, if there are any."""
    noted = store.manifest("sensor_daily").get("note")
    seen = noted["of"] if noted else 0
    missed = store.notes("sensor", seen)
    if not missed:
        return
    known = [n["days"] if n else None for n in missed]
    days = set(store.parts("sensor")) if None in known else {d for some in known for d in some}
    refresh_sensor_daily(store, sorted(days), load_ts)


def changed_readings(stored: DataFrame, readings: DataFrame, keys: Sequence[str], *also: str) -> DataFrame:
    """Readings that are new or of another value than ``stored``: with the value and spelling they replace.

    ``_held`` says whether there was one, ``_old`` is its value and ``_was_*`` how its key is written.
    """
    names = [f"_key_{k}" for k in keys]
    was = {f"_was_{k}": F.col(k) for k in DAILY_KEYS[:2]}
    held = present_keys(stored.withColumns(was), readings, keys, "Tag_Value", *was, *also)
    held = held.withColumnRenamed("Tag_Value", "_old").withColumn("_held", F.lit(True))
    changed = split_join(with_match_keys(readings, keys), held, names, "left")
    changed = changed.withColumn("_held", F.coalesce("_held", F.lit(False)))
    return changed.filter(~(F.col("_held") & F.col("Tag_Value").eqNullSafe(F.col("_old"))))


def merged_sensor_states(states: DataFrame, changed: DataFrame, after: DataFrame) -> DataFrame:
    """Daily states after a load of changed readings.

    ``after`` are the days' readings after the load; they are read for stale states only, if there are any.
    """
    changed = changed.withColumns({k: F.coalesce(f"_was_{k}", k) for k in DAILY_KEYS[:2]})
    added, gone = _states_of(changed), _states_of(changed.filter("_held"), "_old")
    merged = merge_states(states, added, gone, DAILY_KEYS)
    stale = merged.filter(STALE).select(*DAILY_KEYS)
    dated = after.withColumn("Reading_Date", F.col("Trans_Timestamp").cast("date"))
    anew = dated.join(stale, list(DAILY_KEYS), "left_semi").drop("Reading_Date")
    return merged.filter(~F.col(STALE)).drop(STALE).unionByName(_states_of(anew))


def load_sensor_readings(store: TableStore, readings: DataFrame, load_ts) -> int:
    """Upsert the readings that change anything (one per key), and bring the daily states up to date.

    What is stored of the readings' keys is read once: readings that are as stored are not written again, so a replay
    writes nothing. The others are added to the daily states, and the values they replace are taken from them.
    """
    spec, spark = feed("sensor"), store.spark
    catch_up_sensor_daily(store, load_ts)
    base = files.join(work_folder(spark, store), f"sensor-changes-{uuid.uuid4().hex}")
    try:
        held = store.read("sensor", store.slices_in("sensor", readings), with_slice=True)
        changed = settled(spark, changed_readings(held, readings, spec.keys, SLICE), base)
        days = sorted(store.slices_in("sensor", changed))
        if not days:
            return store.manifest("sensor")["version"]
        states = store.read("sensor_daily", days).select(*DAILY_KEYS, *STATE)
        found = changed.filter("_held").select(SLICE, *[f"_key_{k}" for k in spec.keys])
        version, _ = upsert(
            store, "sensor", changed.select(*readings.columns), keys=spec.keys, updates=spec.updates, load_ts=load_ts,
            unique_stage=True, found=found, note={"days": days},
        )
        merged = settled(spark, merged_sensor_states(states, changed, store.read("sensor", days)), files.join(base, "states"))
        _write_states(store, merged, days, load_ts)
        return version
    finally:
        files.delete_tree(spark, base)


def _nullable(spec: FeedSpec) -> list[str]:
    """Match keys of the core that can be NULL: views and decodes fill theirs."""
    return [k for k in spec.nullable_keys if k in set(spec.columns)] if spec.table != "price" else []


def _report_unmapped(landed: Landed, store: TableStore, load: str) -> None:
    """Set aside a copy of the readings that the inner decode joins will drop."""
    seen = Observation()
    lost = plant.inventory_unmapped(
        landed.rows, store.read("container"), store.read("inventory_dcd")
    ).observe(seen, F.count(F.lit(1)).alias("rows"))
    quarantine(
        store,
        landed.spec,
        lost.select(
            F.to_json(F.struct(*landed.spec.columns)).alias(RAW),
            FILE,
            F.concat(F.lit("unmapped:"), F.col("missing")).alias("reason"),
        ),
        load,
        "unmapped",
    )
    landed.report.unmapped = seen.get.get("rows") or 0


def _write(
    spark: SparkSession,
    landed: Landed,
    store: TableStore,
    load_ts,
    on_multi_match: str,
) -> int:
    spec = landed.spec
    rows = shaped(landed, store)
    if spec.write == RELOAD:
        core = table(spec.table)
        return store.overwrite(spec.table, reload(rows, core.data_columns, load_ts, core.audit))
    if spec.write == REPLACE:
        return replace_blend_lab(store, rows, load_ts)
    if spec.name == "inventory":
        _report_unmapped(landed, store, load_id(load_ts))
    rows = settled(spark, rows, landed.path)
    if spec.write == SENSOR:
        return load_sensor_readings(store, rows, load_ts)
    rows = _without_conflicts(landed, rows, store, on_multi_match, load_id(load_ts))
    version, _ = upsert(
        store,
        spec.table,
        rows,
        keys=spec.keys,
        updates=spec.updates,
        load_ts=load_ts,
        nullable_keys=_nullable(spec),
    )
    return version


def _without_conflicts(
    landed: Landed, rows: DataFrame, store: TableStore, on_multi_match: str, load: str
) -> DataFrame:
    """Set aside rows that would update one core row several times, if so asked.

    Otherwise the upsert itself fails on them, and the core stays as it was.
    """
    if on_multi_match != "quarantine":
        return rows
    spec = landed.spec
    core = store.read(spec.table, store.slices_in(spec.table, rows))
    conflicts = multi_match(core, rows, spec.keys)
    aside = with_keys(rows, conflicts, spec.keys)
    count = aside.count()
    if not count:
        return rows
    landed.report.conflicting = count
    quarantine(
        store,
        spec,
        aside.select(
            F.to_json(F.struct(*rows.columns)).alias(RAW),
            F.lit(None).cast("string").alias(FILE),
            F.lit("multi_match").alias("reason"),
        ),
        load,
        "multi_match",
    )
    return without_keys(rows, conflicts, spec.keys)


def load_feed(
    spark: SparkSession,
    spec: FeedSpec,
    store: TableStore,
    data_dir: str,
    load_ts,
    *,
    on_reject: str | None = None,
    on_multi_match: str = "fail",
    archive: bool | None = None,
) -> LoadReport:
    """Run one feed. Without a single good row nothing is written.

    ``load_ts`` names the load: a rerun with the same time replaces what the
    first run set aside. Refused rows go to quarantine, or stop the load (``on_reject="fail"``). A
    feed that replaces what the table holds stops unless asked otherwise, so a
    bad file cannot take the place of good rows.

    Input files are archived (sensor feed, or where asked) only after the new
    version is published, and only those that were read.
    """
    landed = land(spark, spec, store, input_files(spark, spec, data_dir), load_id(load_ts))
    report = landed.report
    try:
        if on_reject is None:
            on_reject = "fail" if spec.write in (RELOAD, REPLACE) else "quarantine"
        if report.rejected and on_reject == "fail":
            raise RejectedRows(f"{spec.name}: {report.rejected} of {report.scanned} rows refused")
        if landed.rows is not None:
            report.version = _write(spark, landed, store, load_ts, on_multi_match)
    finally:
        files.delete_tree(spark, landed.path)
    if archive is None:
        archive = spec.write == SENSOR
    if archive and report.written:
        report.archived = files.archive(spark, report.files)
    return report


def load_prices(
    spark: SparkSession,
    specs: Sequence[FeedSpec],
    store: TableStore,
    data_dir: str,
    load_ts,
) -> list[LoadReport]:
    """Several price feeds in one upsert, so that the price table is rewritten once."""
    landings = [land(spark, s, store, input_files(spark, s, data_dir), load_id(load_ts)) for s in specs]
    ready = [x for x in landings if x.rows is not None]
    try:
        if ready:
            quotes = prices.all_quotes(*[shaped(x, store) for x in ready])
            quotes = settled(spark, quotes, ready[0].path)
            version, _ = upsert(
                store, "price", quotes,
                keys=ready[0].spec.keys, updates=ready[0].spec.updates, load_ts=load_ts,
            )
            for x in ready:
                x.report.version = version
    finally:
        for x in landings:
            files.delete_tree(spark, x.path)
    return [x.report for x in landings]
