"""Records that span lines, in one scan of splittable files.

A line takes the reader from a state to a state: outside or inside a quoted cell. Two marks say how: whether a line that
begins outside ends inside, and whether one that begins inside ends inside. Nearly every line begins and ends outside and
is a record. Each split is followed by a small machine that reads only marks:

- From a line that opens a cell on, lines are pieces until the record is complete. A record cannot be longer than its
  layout allows; an opening quote that is not closed by then is a stray one, and its line stands alone.
- A split other than a file's first may begin inside a record. Its first lines are pieces until reading it from outside
  and reading it from inside agree on where a record ends.

Pieces, few in any file, are landed as raw lines beside the parsed rows. From there they are put together: within a split
by the number of their run, across splits by following, from split to split, which run was still open at the end. No file
is read twice, and no file is read by one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.feeds import FeedSpec

#: What a line is: a record by itself, a line of a file's head, the start of a split that may lie within a record,
#: or else a piece of the split's run of that number.
WHOLE, HEAD, EDGE = 0, -2, -1


def longest_record(spec: FeedSpec) -> int:
    """Characters of the longest record that fits the layout: all quotes doubled, every cell in quotes."""
    return sum(2 * c.width + 3 for c in spec.layout)


def ends_inside(line: Column, sep: str) -> Column:
    """Whether a line that begins outside a quoted cell ends inside one.

    A quote opens a cell only at its beginning. Text after a closing quote belongs to the cell, up to the separator.
    The pattern takes each cell once, without going back.
    """
    s = re.escape(sep)
    body = '[^"]*+(?:""[^"]*+)*+'
    return line.rlike(f'^(?:(?:"{body}"[^{s}]*+|[^"{s}][^{s}]*+|){s})*+"{body}$')


def line_mark(line: Column, sep: str) -> Column:
    """4 times the line's length, plus 2 if it stays inside, plus 1 if it ends inside from outside."""
    quoted = F.contains(line, F.lit('"'))
    opens = F.when(quoted, ends_inside(line, sep)).otherwise(F.lit(False))
    stays = F.when(quoted, ends_inside(F.concat(F.lit('"'), line), sep)).otherwise(F.lit(True))
    return (F.length(line) + 1).cast("long") * 4 + stays.cast("long") * 2 + opens.cast("long")


class Unfinished:
    """The lines since the last complete record, as marks."""

    def __init__(self, most: int):
        self.most = most
        self.marks: list[int] = []
        self.done: list[tuple[int, bool]] = []  # lines of each record, and whether its quotes are closed

    def take(self, mark: int) -> bool:
        """Whether a record is unfinished after one more line."""
        self.marks.append(mark)
        self._finish(False)
        return bool(self.marks)

    def flush(self) -> None:
        self._finish(True)

    def _finish(self, last: bool) -> None:
        marks = self.marks
        while marks:
            lines = 1
            if marks[0] & 1:
                size, lines = marks[0] >> 2, 0
                for k, mark in enumerate(marks[1:], 2):
                    size += mark >> 2
                    if size > self.most:
                        break
                    if not mark & 2:
                        lines = k
                        break
                else:
                    if not last and size <= self.most:
                        return
            self.done.append((lines or 1, bool(lines)))
            del marks[: lines or 1]


class SplitReader:
    """Follows one split; gives a number for each line, see :data:`WHOLE`."""

    def __init__(self, first: bool, skip: int, most: int):
        self.skip = skip if first else 0
        self.most = most
        self.run = 0
        self.open = Unfinished(most)
        self.edge = not first
        self.closed: Unfinished | None = None  # reading on after the record that began before the split
        self.seen = 0

    def _at_edge(self, mark: int) -> int:
        self.seen += mark >> 2
        open_ = self.open.take(mark)
        if self.closed is not None:
            late = self.closed.take(mark)
        elif self.seen > self.most:
            late = False  # no record reaches that far
        elif not mark & 2:
            self.closed, late = Unfinished(self.most), False
        else:
            late = True
        self.edge = open_ or late
        return EDGE

    def read(self, marks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(marks), np.int64)
        at = min(self.skip, len(marks))
        out[:at] = HEAD
        self.skip -= at
        opening = np.flatnonzero(marks & 1)
        while at < len(marks):
            if self.edge:
                out[at] = self._at_edge(int(marks[at]))
            elif self.open.marks:
                out[at] = self.run
                self.open.take(int(marks[at]))
            else:
                k = np.searchsorted(opening, at)
                if k == len(opening):
                    break
                at = int(opening[k])
                self.run += 1
                out[at] = self.run
                self.open = Unfinished(self.most)
                self.open.take(int(marks[at]))
            at += 1
        return out


def line_numbers(spec: FeedSpec):
    """The UDF that numbers lines: of a split's key (negative for a file's first split) and the mark."""
    skip, most = spec.skip, longest_record(spec)

    def number(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        key, reader = None, None
        for keys, marks in batches:
            keys, marks = keys.to_numpy(), marks.to_numpy()
            out = np.zeros(len(keys), np.int64)
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else [0]
            for start, end in zip(edges, edges[1:]):
                if keys[start] != key:
                    key = keys[start]
                    reader = SplitReader(key < 0, skip, most)
                out[start:end] = reader.read(marks[start:end])
            yield pd.Series(out)

    return F.pandas_udf(number, "long").asNondeterministic()


def assembled(pieces: DataFrame, spec: FeedSpec, file: str, block: str, end: str, run: str, row: str, arrival: str, line: str) -> DataFrame:
    """(value, file, arrival, row): records from pieces; a record that is not complete is its first line."""
    most = longest_record(spec)

    @F.pandas_udf("boolean")
    def unfinished(marks: pd.Series, numbers: pd.Series) -> pd.Series:
        def still(some, number) -> bool:
            if number == EDGE:
                reader = SplitReader(False, 0, most)
                reader.read(np.asarray(some, np.int64))
                return reader.edge
            open_ = Unfinished(most)
            return [open_.take(int(m)) for m in some][-1]

        return pd.Series([still(some, number) for some, number in zip(marks, numbers)], dtype=bool)

    @F.pandas_udf("array<int>")
    def lengths(marks: pd.Series) -> pd.Series:
        def of(some) -> list[int]:
            open_ = Unfinished(most)
            for m in some:
                open_.take(int(m))
            open_.flush()
            return [lines for lines, _ in open_.done]

        return marks.map(of)

    marked = pieces.withColumn("_m", line_mark(F.col(line), spec.sep))
    # A run is no longer than a few records.
    some = F.array_sort(F.collect_list(F.struct(F.col(row).alias("row"), F.col(arrival).alias("arrival"), F.col(line).alias("line"), F.col("_m").alias("m"))))
    runs = marked.groupBy(F.col(file).alias("file"), F.col(block).alias("block"), F.col(run).alias("run")).agg(some.alias("lines"), F.max(end).alias("end"))
    runs = runs.withColumn("open", unfinished(F.col("lines.m"), F.col("run")))
    # Runs at the edges of splits: at most two a split. One that is open goes on in the split that begins at its end.
    edge = (F.col("run") == EDGE) | F.col("open")
    order = Window.partitionBy("file").orderBy("block", F.abs("run"), "run")
    follows = (F.col("run") == EDGE) & F.coalesce(F.lag("open").over(order) & (F.lag("end").over(order) == F.col("block")), F.lit(False))
    chained = runs.filter(edge).withColumn("_new", (~follows).cast("int"))
    chained = chained.withColumn("chain", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("block", F.abs("run").alias("run"), "lines")))
    chained = chained.groupBy("file", "chain").agg(parts.alias("parts")).select("file", F.flatten("parts.lines").alias("lines"))
    whole = runs.filter(~edge).select("file", "lines").unionByName(chained)
    whole = whole.withColumn("n", lengths(F.col("lines.m")))
    each = whole.select("file", "lines", F.posexplode("n").alias("k", "many"), "n")
    begin = F.aggregate(F.slice("n", F.lit(1), F.col("k")), F.lit(0), lambda a, x: a + x)
    each = each.select("file", F.slice("lines", begin + 1, F.col("many")).alias("lines"))
    return each.select(
        F.array_join("lines.line", "\n").alias("value"),
        F.col("file").alias(file),
        F.element_at("lines", 1)["arrival"].alias(arrival),
        F.element_at("lines", 1)["row"].alias(row),
    )
