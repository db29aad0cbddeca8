"""Token ids as files of canonical Huffman codes.

Ids are counted over all documents; package-merge gives code lengths of at most ``MAX_BITS``, from which the canonical
codes follow, so a file set needs only its lengths. A document's code starts on a byte, and the bit offset of every
``CHECKPOINT``-th token is kept with it. Blocks of documents in ascending order of ids are rows of Parquet files that
are decoded independently of each other; within a block, the stretches between checkpoints are decoded side by side
through a table of all ``MAX_BITS``-bit windows.

Cases: null and empty texts are the end id alone; very long texts are documents like others; repeated rows and equal
ids are kept in a fixed order (ids, then tokens, then code); null ids come first; an empty table gives empty files.
Columns other than id and text are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import STATE_SCHEMA, settle, shared_dir, state_rows, summed_states, text_of
from .tokens import encoder

END_ID = 1
MAX_BITS = 16
CHECKPOINT = 256
BLOCK_TOKENS = 1 << 16
#: Tokens of documents, or of blocks, that are encoded or decoded side by side; only speed depends on it.
SLICE_TOKENS = 1 << 19
BLOCK_SCHEMA = "part int, block int, start_in_part long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, doc_bytes array<long>, checkpoints array<long>, payload binary"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits; 0 for ids that never occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit into codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    # Package-merge: pairs of the level below join this level's ids; then each chosen item is followed down.
    levels, items = [], weights
    for _ in range(limit - 1):
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank)
        items = merged[rank]
    take = 2 * len(used) - 2
    depth = np.zeros(len(used), np.int64)
    for rank in reversed(levels):
        chosen = rank[:take]
        leaves = chosen < len(used)
        depth[chosen[leaves]] += 1
        take = 2 * int((~leaves).sum())
    depth[:take] += 1
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for k in np.lexsort((np.arange(len(lengths)), lengths)):
        if lengths[k]:
            code <<= int(lengths[k]) - before
            codes[k], before = code, int(lengths[k])
            code += 1
    return codes


def decoding_table(lengths: np.ndarray, limit: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for each window of ``limit`` bits."""
    ids, bits = np.zeros(1 << limit, np.uint32), np.zeros(1 << limit, np.uint8)
    used = np.flatnonzero(lengths)
    starts = canonical_codes(lengths)[used].astype(np.int64) << (limit - lengths[used].astype(np.int64))
    for k, at in zip(used, starts):
        span = slice(at, at + (1 << (limit - int(lengths[k]))))
        ids[span], bits[span] = k, lengths[k]
    return ids, bits


def encode_ids(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The code of a document and the bit offsets of its checkpoints."""
    code, _, checkpoints = encode_documents(ids, np.array([len(ids)]), lengths, codes)
    return code, checkpoints


def encode_documents(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The codes of documents one after the other, the bytes of each, and the bit offsets of their checkpoints, from 0 in each.

    ``ids`` are those of all documents, ``counts`` how many each has.
    """
    size = lengths[ids].astype(np.int64)
    end = np.append(0, np.cumsum(size))
    first = np.cumsum(counts) - counts
    n_bytes = (end[first + counts] - end[first] + 7) // 8
    begin = 8 * (np.cumsum(n_bytes) - n_bytes)
    at = end[:-1] + np.repeat(begin - end[first], counts)
    total = int(n_bytes.sum())
    words = np.zeros(total // 8 + 2, np.uint64)
    word, free = at >> 6, 64 - (at & 63) - size  # bits left in the word; negative if the code runs over
    code = codes[ids]
    here = np.where(free >= 0, code << np.maximum(free, 0).astype(np.uint64), code >> np.maximum(-free, 0).astype(np.uint64))
    if len(ids):
        change = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[change]] = np.bitwise_or.reduceat(here, change)
        over = np.flatnonzero(free < 0)
        words[word[over] + 1] |= code[over] << (64 + free[over]).astype(np.uint64)
    marks = np.flatnonzero((np.arange(len(ids)) - np.repeat(first, counts)) % CHECKPOINT == 0)
    checkpoints = at[marks] - np.repeat(begin, -(-counts // CHECKPOINT))
    return words.byteswap().tobytes()[:total], n_bytes, checkpoints


def _shares(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of rows with about ``SLICE_TOKENS`` tokens each, one row at least."""
    at, ends = 0, np.cumsum(counts)
    while at < len(counts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_TOKENS, "right")))
        yield at, stop
        at = stop


def decode_stretches(payload: bytes, starts: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray], limit: int = MAX_BITS) -> np.ndarray:
    """Ids of stretches of code, one after the other; all stretches advance together."""
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    ids, bits = table
    begin = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint32)
    order = np.argsort(-counts, kind="stable")
    at, place, left = starts[order].astype(np.int64), begin[order], counts[order]
    for step in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -step, "left"))
        pos = at[:live]
        byte = pos >> 3
        window = ((data[byte] << 16) | (data[byte + 1] << 8) | data[byte + 2]) >> (24 - limit - (pos & 7)).astype(np.uint32) & ((1 << limit) - 1)
        out[place[:live] + step] = ids[window]
        at[:live] += bits[window]
    return out


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) with ids in two bytes each where the vocabulary allows it, else four."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        end, kind = np.array([end_id], "<u4").tobytes(), "<u2" if known.size <= 1 << 16 else "<u4"
        for batch in batches:
            ids = [np.frombuffer(x + end, "<u4").astype(kind).tobytes() for x in known.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, ids binary")


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode documents to ``path``: folder ``blocks`` with the code, folder ``lengths`` with the code lengths."""
    spark = docs.sparkSession
    size = encoder(tokenizer).size
    kind = "<u2" if size <= 1 << 16 else "<u4"
    tokens = settle(tokenised(docs, tokenizer, end_id), "tokens")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind)
            total += np.bincount(ids, minlength=size)
        yield from state_rows(total)

    lengths = code_lengths(summed_states(tokens.select("ids").mapInArrow(count, STATE_SCHEMA), size))
    codes = canonical_codes(lengths)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/lengths")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            counts = np.array([len(x) // np.dtype(kind).itemsize for x in texts], np.int64)
            for a, b in _shares(counts):
                n = counts[a:b]
                code, n_bytes, checkpoints = encode_documents(np.frombuffer(b"".join(texts[a:b]), kind), n, lengths, codes)
                ends = np.append(0, np.cumsum(n_bytes)).tolist()
                marks = np.append(0, np.cumsum(-(-n // CHECKPOINT))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(n), pa.array([code[x:y] for x, y in zip(ends, ends[1:])], pa.binary()), pa.ListArray.from_arrays(marks, pa.array(checkpoints))],
                    ["part", "doc_id", "n_tokens", "code", "checkpoints"],
                )

    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = ", ".join(str(k / parts) for k in range(1, parts))
    bounds = tokens.agg(F.expr(f"percentile_approx(doc_id, array({share}), {20 * parts})").alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    # The number of bounds at or below an id, by halving.
    part = F.coalesce(_rank(F.col("doc_id"), bounds, 0, len(bounds)), F.lit(0)).cast("int")
    coded = tokens.select(part.alias("part"), "doc_id", "ids").mapInArrow(encode, "part int, doc_id long, n_tokens long, code binary, checkpoints array<long>")
    sorted_docs = coded.repartition(parts, "part").sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "n_tokens", "code")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start, held, n_held = None, 0, 0, [], 0

        def emit() -> pa.RecordBatch:
            row = {
                "part": part, "block": block, "start_in_part": start, "n_tokens": n_held, "doc_ids": [d[0] for d in held], "doc_tokens": [d[1] for d in held],
                "doc_bytes": [len(d[2]) for d in held], "checkpoints": [c for d in held for c in d[3]], "payload": b"".join(d[2] for d in held),
            }
            return pa.RecordBatch.from_pylist([row], schema=block_schema)

        for batch in batches:
            for p, *doc in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (p != part or n_held >= BLOCK_TOKENS):
                    yield emit()
                    start, block, held, n_held = start + n_held, block + 1, [], 0
                if p != part:
                    part, block, start = p, 0, 0
                held.append(doc)
                n_held += doc[1]
        if held:
            yield emit()

    longs = pa.list_(pa.int64())
    block_schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", longs), ("doc_tokens", longs), ("doc_bytes", longs), ("checkpoints", longs), ("payload", pa.binary())])
    sorted_docs.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def _rank(column, bounds: list[int], low: int, high: int):
    """How many of the sorted bounds are at or below a column, as a balanced CASE."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(column >= bounds[middle], _rank(column, bounds, middle + 1, high)).otherwise(_rank(column, bounds, low, middle))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids_crc32, and the ids if asked for."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/lengths").first()["lengths"]), np.uint8)
    # One number per part: parts are as many as the job had partitions, times four.
    totals = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    begin, at = {}, 0
    for part in sorted(totals):
        begin[part], at = at, at + totals[part]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths)
        for batch in batches:
            for a, b in _shares(batch.column("n_tokens").to_numpy()):
                some = batch.slice(a, b - a)
                doc_ids, tokens, size, checkpoints = (some.column(c).flatten() for c in ("doc_ids", "doc_tokens", "doc_bytes", "checkpoints"))
                tokens, size = tokens.to_numpy(), size.to_numpy()
                stretches = -(-tokens // CHECKPOINT)
                doc = np.repeat(np.arange(len(tokens)), stretches)
                starts = checkpoints.to_numpy() + 8 * (np.cumsum(size) - size)[doc]
                rank = np.arange(len(doc)) - (np.cumsum(stretches) - stretches)[doc]
                counts = np.minimum(CHECKPOINT, tokens[doc] - rank * CHECKPOINT)
                ids = decode_stretches(b"".join(some.column("payload").to_pylist()), starts, counts, table).astype("<u4")
                ends = np.cumsum(tokens)
                each = [ids[y - n : y].tobytes() for y, n in zip(ends.tolist(), tokens.tolist())]
                of_block = some.column("n_tokens").to_numpy()
                before = np.array([begin[p] for p in some.column("part").to_pylist()], np.int64) + some.column("start_in_part").to_numpy() - (np.cumsum(of_block) - of_block)
                start = np.repeat(before, [len(x) for x in some.column("doc_ids")]) + ends - tokens
                columns = [doc_ids, pa.array(start), pa.array(tokens), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(each, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write documents to files in the shared folder and read them back."""
    path = f"{shared_dir(docs.sparkSession)}/llm-token-files-{uuid.uuid4().hex}"
    write_token_files(docs, tokenizer, path, end_id)
    return read_token_files(docs.sparkSession, path)
