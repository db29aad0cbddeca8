"""Helpers of several operators: shared storage, joins that hot keys cannot block, sums of task states."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.sources import files

#: Fixed value: what separates words, in Java's and DuckDB's regular expressions alike.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; one is made only where the session names none (local runs and tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if folder is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="feedmill-llm-"))
    return folder or context.getCheckpointDir()


def settle(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, and safe from lost executors.

    The shuffle files below it are of no use from then on; Spark deletes them when the driver's JVM collects its garbage,
    which is asked for here, as a driver with little to do may not do so for long.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing will read again."""
    for table in tables:
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            files.delete_tree(table.sparkSession, folder)


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join a side with hot keys to one that has each key once.

    The extra key asks for an exchange of its own on both sides, so adaptive execution can split a hot partition
    of the left side even where the right side comes straight from an aggregate.
    """
    extra = F.xxhash64(*keys)
    return left.withColumn("_extra", extra).join(right.withColumn("_extra", extra), [*keys, "_extra"], how).drop("_extra")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_mod(column: str, n: int) -> Column:
    """crc32 of an id written as text, modulo n; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal keys in a sorted stream, with the keys; a run may cross batches."""
    held: list[pa.RecordBatch] = []
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            if batch.num_rows > 1:
                change[1:] |= pc.fill_null(pc.not_equal(column[1:], column[:-1]), True).to_numpy(zero_copy_only=False)
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            key = tuple(c[a].as_py() for c in columns)
            if held and key != before:
                yield before, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            before = key
    if held:
        yield before, pa.Table.from_batches(held)


# -- arrays of integers that every task gathers and that are summed over tasks

SLICE = 1 << 14
STATE_SCHEMA = "slice int, state binary"


def state_rows(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The non-zero slices of a task's int64 array, as rows."""
    flat = total.ravel()
    for k, at in enumerate(range(0, len(flat), SLICE)):
        part = flat[at : at + SLICE]
        if part.any():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([k], pa.int32()), "state": pa.array([part.astype("<i8").tobytes()], pa.binary())})


def summed_states(states: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' arrays; its size is fixed by the operator, so the driver may hold it.

    Rows are summed within each task of the mid step first, so the driver gets a few arrays and not one per task.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, state in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(state, "<i8")
                sums[k] = sums[k] + part if k in sums else part
        for k, part in sums.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([k], pa.int32()), "state": pa.array([part.tobytes()], pa.binary())})

    total = np.zeros(-(-size // SLICE) * SLICE, np.int64)
    for row in states.repartition(F.col("slice"), F.pmod(F.xxhash64("state"), F.lit(4))).mapInArrow(fold, STATE_SCHEMA).toLocalIterator():
        at = row["slice"] * SLICE
        part = np.frombuffer(row["state"], "<i8")
        total[at : at + len(part)] += part
    return total[:size]
