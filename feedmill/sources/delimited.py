"""Delimited drop files as all-text DataFrames.

Files are read as lines, so large files split, and parsed by ``from_csv``. A record that spans lines is met as pieces,
see :mod:`feedmill.sources.records`: rows whose ``PIECE`` is not 0 hold a raw line and no cells. A load lands them with
the others and parses what they make from there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.feeds import FeedSpec
from feedmill.operators.normalise import fill_empty
from feedmill.sources.records import HEAD, assembled, ends_inside, line_mark, line_numbers

FILE, ARRIVAL, RAW, MALFORMED, PIECE = "_file", "_arrival", "_raw", "_malformed", "_piece"
ROW, BLOCK, BLOCK_END = "_row", "_block", "_block_end"


def any_case(mask: str) -> str:
    """A file mask as a glob that ignores case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in mask)


def _csv_options(spec: FeedSpec) -> dict[str, str]:
    return {
        "sep": spec.sep,
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": MALFORMED,
    }


def _located(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add where a row comes from. Arrival orders files and splits."""
    meta = "_metadata."
    arrival = F.struct(
        F.col(meta + "file_modification_time").alias("modified"),
        F.col(meta + "file_path").alias("file"),
        F.col(meta + "file_block_start").alias("block"),
    )
    return df.select(
        *columns,
        F.col(meta + "file_path").alias(FILE),
        F.col(meta + "file_block_start").alias(BLOCK),
        (F.col(meta + "file_block_start") + F.col(meta + "file_block_length")).alias(BLOCK_END),
        arrival.alias(ARRIVAL),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Add a number that grows within a split; with the arrival it orders all rows."""
    return rows.withColumn(ROW, F.monotonically_increasing_id())


def parse_lines(records: DataFrame, spec: FeedSpec) -> DataFrame:
    """Records (column ``value``) to the feed's columns, bound by position. Columns of the scan itself stay."""
    schema = ", ".join(f"`{n}` STRING" for n in [*spec.columns, MALFORMED])
    own = [c for c in records.columns if c != "value"]
    whole = F.col(PIECE) == 0 if PIECE in own else F.lit(True)
    cells = F.from_csv(F.when(whole, F.col("value")), schema, _csv_options(spec))
    out = records.withColumn("_cells", cells).select("_cells.*", *own, F.col("value").alias(RAW))
    torn = F.contains(RAW, F.lit('"')) & ends_inside(F.col(RAW), spec.sep)
    out = out.withColumn(MALFORMED, whole & (F.col(MALFORMED).isNotNull() | torn))
    return fill_empty(out, spec.columns)


def _lines(lines: DataFrame, spec: FeedSpec) -> DataFrame:
    """Lines of all files without their heads and without blank ones, pieces numbered.

    The head of a file is in the split that starts at offset 0, and a task reads a split in order, so counting rows
    within the task is enough: no second scan and no shuffle. Two numbers per row pass through Python.
    """
    first = F.col(BLOCK) == 0
    key = F.xxhash64(FILE, BLOCK).bitwiseAND(F.lit((1 << 62) - 1))
    key = F.when(first, -1 - key).otherwise(key)
    lines = lines.withColumn(PIECE, line_numbers(spec)(key, line_mark(F.col("value"), spec.sep)))
    return lines.filter((F.col(PIECE) != HEAD) & ((F.col("value") != "") | (F.col(PIECE) != 0)))


def scan_lines(spark: SparkSession, spec: FeedSpec, paths: Sequence[str]) -> DataFrame:
    """All records of ``paths`` that are lines, and the pieces of the others; numbered."""
    lines = _located(spark.read.format("text").load(list(paths)), ["value"])
    return numbered(parse_lines(_lines(lines, spec), spec))


def scan_stream(spark: SparkSession, spec: FeedSpec, folder: str, **options) -> DataFrame:
    """The same scan as a stream over a drop folder; rows are numbered per batch."""
    reader = spark.readStream.option("pathGlobFilter", any_case(spec.mask)).options(**options)
    lines = _located(reader.format("text").load(folder), ["value"])
    return parse_lines(_lines(lines, spec), spec)


def from_pieces(pieces: DataFrame, spec: FeedSpec) -> DataFrame:
    """The records that landed pieces make, parsed like the others."""
    records = assembled(pieces, spec, FILE, BLOCK, BLOCK_END, PIECE, ROW, ARRIVAL, RAW)
    records = records.filter(F.col("value") != "").withColumn(PIECE, F.lit(0).cast("long"))
    blocks = {BLOCK: F.lit(None).cast("long"), BLOCK_END: F.lit(None).cast("long")}
    return parse_lines(records.withColumns(blocks), spec)


def scan(spark: SparkSession, spec: FeedSpec, paths: Sequence[str]) -> DataFrame:
    """All records of ``paths``, to look at; a load lands its lines first and reads the files once."""
    rows = scan_lines(spark, spec, paths)
    return rows.filter(F.col(PIECE) == 0).unionByName(from_pieces(rows.filter(F.col(PIECE) != 0), spec))
