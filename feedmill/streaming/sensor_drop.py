"""Sensor files as they arrive in a drop folder.

The stream remembers the files it has seen, so each is read once. A batch is
upserted by location, tag and time and the summary of its days is recomputed:
replaying a batch after a failure gives the same tables, and late or corrected
readings need no watermark.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feedmill.feeds import feed
from feedmill.plans.loader import (
    checked,
    good_rows,
    load_sensor_readings,
    quarantine,
    refused,
    settled,
    work_folder,
    write_landing,
)
from feedmill.plans.plant import sensor_readings
from feedmill.sources import files
from feedmill.sources.delimited import ARRIVAL, ROW, numbered, scan_stream
from feedmill.sources.store import TableStore


def sensor_stream(
    spark: SparkSession, folder: str, archive_dir: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Checked sensor rows from a folder; finished files can move to an archive."""
    options = {}
    if archive_dir:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    if max_files:
        options |= {"maxFilesPerTrigger": str(max_files)}
    spec = feed("sensor")
    return checked(scan_stream(spark, spec, folder, **options), spec)


def sensor_batch(
    store: TableStore, clock: Callable[[], object], stream: str = "stream"
) -> Callable[[DataFrame, int], None]:
    """What is done with one batch of checked rows. A replayed batch has the same load name."""

    def handle(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        base = files.join(work_folder(spark, store), f"sensor-batch-{uuid.uuid4().hex}")
        path = files.join(base, "stage")
        try:
            landed, counts = write_landing(numbered(rows), feed("sensor"), path)
            bad, good = refused(landed), good_rows(landed)
            if counts["rejected"]:
                quarantine(store, feed("sensor"), bad, f"{stream}-{batch}", "refused")
            if counts["scanned"] == counts["rejected"]:
                return
            readings = settled(spark, sensor_readings(good, (ARRIVAL, ROW)), base)
            load_sensor_readings(store, readings, clock())
        finally:
            files.delete_tree(spark, base)

    return handle


def ingest_sensor_drop(
    spark: SparkSession,
    store: TableStore,
    folder: str,
    checkpoint: str,
    *,
    archive_dir: str | None = None,
    max_files: int | None = None,
    clock: Callable[[], object] | None = None,
) -> StreamingQuery:
    """Take in everything that is in the folder now, then stop."""
    now = clock or (lambda: datetime.now(UTC).replace(tzinfo=None).isoformat(" ", "seconds"))
    # Batches are counted per checkpoint.
    stream = f"stream-{uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]}"
    return (
        sensor_stream(spark, folder, archive_dir, max_files)
        .writeStream.foreachBatch(sensor_batch(store, now, stream))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
