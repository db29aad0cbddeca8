"""Best-fit packing of documents into sequences of fixed length by sums of squares.

A document's tokens end with ``END_ID``. Longer documents than a sequence are cut into whole sequences; a shorter first
piece remains. Pieces are dealt at random into groups of about ``GROUP_PIECES`` and taken longest first: each goes to
the open sequence, or to a new one, after which the sum over all residual gaps of the squared number of open sequences
with that gap is least; ties go to the fullest. After each round the sequences that are full, up to a small slack, are
closed. The others are opened up and their pieces dealt anew, so few groups leave sequences half empty; the last round
closes all. A group is all that a task holds, and the state of the packing is one count per gap.

Cases: null and empty texts are a single end token; very long texts give as many pieces as needed; repeated rows are
packed each; ties are broken by the order of ids; an empty table gives an empty result. Columns other than id and text
are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import settle, text_of
from .tokens import encoder

SEQUENCE_TOKENS = 2048
END_ID = 0
GROUP_PIECES = 8192
#: Tokens that may stay free in a sequence that a round closes; the last round closes all.
SLACK = (0, 0, 1, 2, None)
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents, with their ids (little-endian unsigned 32-bit) if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            columns: list[list] = [[] for _ in range(5 + with_ids)]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n % size or size, n + 1, size)] if n > size else [0, n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[4 * a : 4 * b]
                    for column, value in zip(columns, (doc, k, a, b - a, zlib.crc32(part), part)):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names[: len(columns)])

    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return df.mapInArrow(run, PIECE_SCHEMA + ", ids binary" * with_ids)


def sum_of_squares(lengths: list[int], size: int) -> list[list[int]]:
    """Sequences as lists of positions, for lengths taken in their order."""
    open_at = np.zeros(size + 1, np.int64)  # sequences by the tokens they hold; full ones don't count
    stacks: dict[int, list[list[int]]] = {}
    full: list[list[int]] = []
    never = np.iinfo(np.int64).max
    for k, length in enumerate(lengths):
        sequence, level = [k], 0
        if length < size:
            old = open_at[: size - length + 1]
            change = np.where(old > 0, 2 * (open_at[length:] - old) + 2, never)
            if old[-1]:
                change[-1] -= 1  # a sequence that gets full leaves the sum
            best = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[best] < never and change[best] <= 2 * open_at[length] + 1:
                sequence, level = stacks[best].pop(), best
                open_at[best] -= 1
                sequence.append(k)
        if level + length < size:
            open_at[level + length] += 1
            stacks.setdefault(level + length, []).append(sequence)
        else:
            full.append(sequence)
    return full + [s for level in sorted(stacks) for s in stacks[level]]


def _round(df: DataFrame, groups: int, number: int, size: int, slack: int | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(group: int, part: int, rows: list[tuple]) -> pa.RecordBatch:
            lengths = [r[4] for r in rows]
            ids: list[int | None] = [None] * len(rows)
            offsets: list[int | None] = [None] * len(rows)
            for local, sequence in enumerate(sum_of_squares(lengths, size)):
                at = [0]
                for k in sequence:
                    at.append(at[-1] + lengths[k])
                if slack is None or size - at[-1] <= slack:
                    for k, offset in zip(sequence, at):
                        ids[k], offsets[k] = (number << 60) + (group << 36) + (part << 15) + local, offset
            columns = [list(c) for c in zip(*rows)][1:] + [ids, offsets]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*out_names, "sequence_id", "offset"])

        def stream():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for group, rows in groupby(stream(), key=lambda r: r[0]):
            part, held = 0, []
            for r in rows:  # a group that repeated rows have made large is packed in parts
                held.append(r)
                if len(held) == 4 * GROUP_PIECES:
                    yield emit(group, part, held)
                    part, held = part + 1, []
            if held:
                yield emit(group, part, held)

    out_names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    deal = F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32", F.lit(number)), F.lit(groups))
    dealt = df.select(deal.alias("deal"), *out_names).repartition("deal").sortWithinPartitions("deal", F.desc("length"), "doc_id", "piece")
    return dealt.mapInArrow(run, PIECE_SCHEMA + ", sequence_id long, offset long")


def pack_pieces(cut: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """Give each piece (columns of ``pieces``) its sequence and its place there."""
    rest, packed = settle(cut.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces"), []
    for number, slack in enumerate(SLACK):
        n = rest.count()
        if not n and packed:
            break
        last = slack is None or n <= GROUP_PIECES // 16
        done = settle(_round(rest, max(1, math.ceil(n / GROUP_PIECES)), number, size, None if last else slack), "packed")
        packed.append(done.filter("sequence_id IS NOT NULL"))
        if last:
            break
        rest = done.filter("sequence_id IS NULL").drop("sequence_id", "offset")
    result = packed[0]
    for more in packed[1:]:
        result = result.union(more)
    return result


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document."""
    return pack_pieces(pieces(docs, tokenizer, size, end_id), size)
