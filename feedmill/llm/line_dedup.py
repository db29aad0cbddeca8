"""Fuzzy line deduplication.

Lines in lower case, with runs of all but letters and digits as single spaces, are compared if they have ``min_words``
words or more. A character of a script without spaces (Chinese, Japanese, Thai and others) is a word. Equal lines meet by
hash, counted with a map-side combine. Distinct ones link if their edit distance in words is at most ``1 - SIMILARITY`` of
the longer line's words; at this similarity, lines of fewer than 4 words only link when equal.

Blocks. A fifth of the words changed moves a line's SimHash by some 13 bits of 64, and pigeonhole blocks for that radius
have 4 bits: they meet everything. So lines meet by pieces that such a distance leaves whole, which is the pigeonhole
argument on words: up to 9 words, one edit, the line without any one of its words; from 8 words on, a run of 3 words. All
runs of a line count, so no pair is missed. (``sampled=True`` only takes runs that begin with certain words of lines of
``SAMPLED`` words or more, and misses pairs; no query uses it.)

Two exact bounds keep most runs from being shuffled with their lines. Runs are first counted alone, 4 bytes each in buckets
of their hashes, and those of one line go. An edit changes 3 runs at most, so a line with more unshared runs than its edits can
change has no partner and goes whole; a bitmap of fixed size (``FILTER_BITS``) tells so before the shuffle, but for a few
that the counts of blocks then remove. Of the runs that a line shares, the least frequent are its blocks, one more than the
edits can change beside the unshared ones (prefix filtering: the least frequent run that two lines within the distance
have in common is among these of both).

Frequent blocks. Blocks are counted again, and those of one line go; of blocks that hold the same lines (long lines that
are alike share many runs) one stays. A block of more than ``PAIRED`` lines is refined: of the
lines that have such blocks the words are counted too, and the block is joined with each of a line's rarest words, as many
as the edits allow and one more (prefix filtering: two lines within the distance share one of these; a word that no other
such line has lowers the number, and a line with more of them than edits allowed has no partner). So a phrase that many
lines share never makes pairs by itself.

Lines that meet are compared by a 64-bit SimHash of their words, in the bits that no number of edits allowed can turn, by a
parity of words in ``PARITY`` numbers of 64 bits, which each edit changes in two bits at most, and then by edit distance, with a letter for each word (2 ** 20
letters, by hash). In a block of ``PAIRED`` lines at most the tests are done in numpy. The pairs of the least line and, ``PIVOTS`` times, of
the least one that is not near these are measured first; after these links are contracted, those that lead from one group to another. A larger
block is worked by joins: all lines are first held against the least; after those links are contracted, the least of the lines
outside its group is held against the others and leaves the block, ``PIVOTS`` times, each time with what links contracted. What is then
still outside is held against the others, unless the two are known to share a larger block too. Of each connected group the first occurrence stays, in the order
of doc_id (null last) and line.

Lines are cut, hashed and sketched in numpy over Arrow batches, some lines at a time; counting, joining, comparing and
grouping are DataFrame work. Functions over arrays, which Spark interprets, took most of the time of a native form.

Cases: null texts have no lines and stay; a document whose every line with a word goes is left out by
``dedup_documents`` and has empty text in the report; texts without words, and lines of fewer words, stay as they are;
very long lines count whole; rows with equal id and text
are one document that stands several times; rows with equal id and other texts are told apart by the text's hash, and
keep a line both where it is first at the same place. An empty table gives an empty result. Extra columns are kept;
names that begin with ``_ld_`` are the operator's own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.operators.keyfilter import key_filter, might_hold

from .components import components
from .shared import STATE_SCHEMA, WORD, discard, grouped, settle, split_join, state_rows, summed_states, text_of
from .winnowing import Words, _mixed, _slices

MIN_WORDS = 1
SIMILARITY = 0.8
#: Runs are counted by buckets of their hashes, named by so many bits; the rest of a hash fits 4 bytes.
BUCKET_BITS = 10
#: Pairs that a task tests at a time.
TESTED = 1 << 20
#: Places of a fixed-size array, of a byte each, that says how frequent pieces are (4 MB); it sets an order only.
LEVELS = 1 << 22
#: Runs that a task holds before it deals them to buckets (32 MB).
HELD = 1 << 22
#: Bits of the filter of shared pieces; its size is the bound of what is sent to every task (16 MB).
FILTER_BITS = 1 << 27
#: Bits of a piece's hash; equal hashes of different pieces only make lines meet once more.
PART_BITS = 40
#: Words from which on a line gives a part of its runs only, if sampled.
SAMPLED = 20
#: Lines of a block up to which all its pairs that may be alike are noted at once, before any are linked.
HOT = 64
#: Lines of a block up to which its pairs are tested one by one, in numpy; a larger one is refined by words.
PAIRED = 1024
#: Counters of the words of lines in frequent blocks; a fixed-size array that every task gets.
COUNTERS = 1 << 18
#: Numbers of 64 bits of a line's parity. One alone says nothing on lines of some 80 words, whose edits may turn all of its bits.
PARITY = 4
#: Larger blocks of a line that each of its blocks knows, to meet a pair once and not in every block it shares.
BEFORE = 4
#: Times that a line of each block outside its least line's group is held against the block, before the others are held against each other.
PIVOTS = 2
_ODD = [f"odd{i}" for i in range(PARITY)]
_LAST = (1 << 63) - 1
#: Characters of lines that are handed on at a time.
PIECE = 1 << 22
#: Fixed value: scripts that set no spaces between words, and a range that holds all of their characters.
_UNSPACED = regex.compile("[" + "".join(rf"\p{{Script={name}}}" for name in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")) + "]")
_MAYBE_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u19e0-\u19ff\u2e80-\U0010ffff]")
#: All but letters, digits and white space; a mark is no letter.
_OTHER = re.compile(r"[^\w\s]|_")
#: The same for bytes below 128, and white space but line ends: all become spaces, in one step for a text. Longer bytes stay as they are.
_BYTES = bytes(b if b >= 128 or b == 10 or chr(b).isalnum() else 32 for b in range(256))


def normalised(text: str) -> list[str]:
    """The lines of a text in compared form: words with single spaces between them."""
    lower = text.lower().encode("utf-8", "surrogatepass").translate(_BYTES).decode("utf-8", "surrogatepass")
    if not lower.isascii():
        if _MAYBE_UNSPACED.search(lower):
            lower = _UNSPACED.sub(r" \g<0> ", lower)
        lower = _OTHER.sub(" ", lower)
    return [" ".join(line.split()) for line in lower.split("\n")]


def line_table(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per compared line: document, place, two hashes of the normalised line, and the line."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            doc, tie, pos, norm = zip(*rows)
            coded = [x.encode() for x in norm]
            k = np.array([xxhash.xxh64_intdigest(x) for x in coded], np.uint64).view(np.int64)
            k2 = np.array([zlib.crc32(x) for x in coded], np.uint32).view(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(tie, pa.int64()), pa.array(pos, pa.int32()), pa.array(k), pa.array(k2), pa.array(norm, pa.string())], ["doc", "tie", "pos", "k", "k2", "norm"])

        for some in batches:
            for doc, tie, text in zip(*(c.to_pylist() for c in some.columns)):
                for pos, norm in enumerate(normalised(text)):
                    if norm and norm.count(" ") >= min_words - 1:
                        rows.append((doc, tie, pos, norm))
                        size += len(norm) + 64
                        if size > PIECE:
                            yield batch()
                            rows, size = [], 0
        if rows:
            yield batch()

    return docs.select(*_document(), text_of().alias("text")).mapInArrow(cut, "doc long, tie long, pos int, k long, k2 int, norm string")


def _document() -> list[Column]:
    """A document by id, and by the hash of its text beside it; a missing id comes last."""
    ids = F.col("doc_id").cast("long")
    return [F.coalesce(ids, F.lit(_LAST)).alias("doc"), F.xxhash64(text_of(), ids.isNull()).alias("tie")]


def _pieces(batches: Iterator[pa.RecordBatch], sampled: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Keys and word numbers of some lines, and line and hash of each piece of them, once a line, by line.

    The longer line of a pair has L words, of which d = L // 5 may go: (L - d) / (d + 1) words, rounded up, stay in a
    row: 3 or more from 10 words on; the shorter line has four fifths of L or more.
    """
    for keys, words in _words_of(batches):
        h, n, first = words.hash, words.count, words.first
        parts, lines = [], []
        for size in range(4, 10):
            which = np.flatnonzero(n == size)
            w = h[first[which][:, None] + np.arange(size)]
            left = [w] if size == 4 else [w, *(np.delete(w, i, 1) for i in range(size))]
            parts += [_joined(x, 1) for x in left]
            lines += [which] * len(left)
        many = n[words.text]
        drawn = np.zeros(len(h), np.uint64)
        for k in range(13 if sampled else 0):
            drawn[many >= (SAMPLED if k == 0 else int(1.6 * SAMPLED) << (k - 1))] = (2 << k) - 1
        runs = words.whole(3)
        at = np.flatnonzero(runs & (many[: len(runs)] >= 8) & (h[: len(runs)] & drawn[: len(runs)] == 0))
        parts.append(_joined(np.lib.stride_tricks.sliding_window_view(h, 3), 3)[at] if len(runs) else h[:0])
        lines.append(words.text[at])
        # A slice has fewer than 2 ** 24 lines; line and piece fit one number. Sorted in place: np.unique hashes, which takes many times as long.
        both = np.concatenate(lines).astype(np.uint64) << np.uint64(PART_BITS) | np.concatenate(parts) >> np.uint64(64 - PART_BITS)
        both.sort()
        both = both[np.append(True, both[1:] != both[:-1])[: len(both)]]
        yield keys, n, (both >> np.uint64(PART_BITS)).astype(np.int64), (both & np.uint64((1 << PART_BITS) - 1)).view(np.int64)


def _blocks(distinct: DataFrame, sampled: bool) -> DataFrame:
    """(part, k): a row for each piece of each line of 4 words or more."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, _, line, part in _pieces(batches, sampled):
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(keys[line])], ["part", "k"])

    return distinct.select("k", "norm").mapInArrow(rows, "part long, k long")


def _piece_counts(distinct: DataFrame, sampled: bool) -> DataFrame:
    """(bucket, bits, levels): which pieces are of more than one line, and of how many, for each bucket of their hashes.

    Pieces travel as sorted numbers of 4 bytes, all of a bucket in one row, so that neither end of the shuffle sees a row a
    piece; a bucket is counted by sorting it. Its rows have a fixed size: a bit, and the most lines by their logarithm, for each place.
    """
    low = PART_BITS - BUCKET_BITS

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def rows() -> pa.RecordBatch:
            part = np.concatenate(held)
            part.sort()
            begin = np.searchsorted(part, np.arange((1 << BUCKET_BITS) + 1) << low)
            used = np.flatnonzero(np.diff(begin))
            data = (part & ((1 << low) - 1)).astype("<u4")
            offsets = (4 * np.append(begin[used], len(part))).astype(np.int32)
            blobs = pa.BinaryArray.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), blobs], ["bucket", "pieces"])

        for _, _, _, part in _pieces(batches, sampled):
            held.append(part)
            size += len(part)
            if size > HELD:
                yield rows()
                held, size = [], 0
        if size:
            yield rows()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), table in grouped(batches, ["bucket"]):
            part = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table.column("pieces")])
            part.sort()
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            many = np.diff(np.append(first, len(part)))
            part, many = part[first[many > 1]], many[many > 1]
            bits = np.zeros(FILTER_BITS >> BUCKET_BITS, bool)
            bits[part >> np.uint32(PART_BITS + 1 - FILTER_BITS.bit_length())] = True
            levels = np.zeros(LEVELS >> BUCKET_BITS, np.uint8)
            np.maximum.at(levels, part >> np.uint32(PART_BITS + 1 - LEVELS.bit_length()), np.minimum(255, 8 * np.log2(many)).astype(np.uint8))
            data = [np.packbits(bits, bitorder="little").tobytes(), levels.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *[pa.array([x], pa.binary()) for x in data]], ["bucket", "bits", "levels"])

    pieces = distinct.select("k", "norm").mapInArrow(dealt, "bucket int, pieces binary")
    return settle(pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(counted, "bucket int, bits binary, levels binary"), "line-pieces")


def _filters(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Which bits the pieces set, as packed bytes, and the levels of their places; a row for each bucket reaches the driver."""
    bits, levels = np.zeros((1 << BUCKET_BITS, FILTER_BITS >> BUCKET_BITS + 3), np.uint8), np.zeros((1 << BUCKET_BITS, LEVELS >> BUCKET_BITS), np.uint8)
    for row in counts.toLocalIterator():
        bits[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
        levels[row["bucket"]] = np.frombuffer(row["levels"], np.uint8)
    return bits.ravel(), levels.ravel()


def _lost_runs(words: np.ndarray) -> np.ndarray:
    """The most runs of 3 words of such a line that a partner can lack: 3 an edit, 2 an insertion, for all partners' lengths.

    A partner with as many words allows n // 5 edits. Each word more is an insertion, and n % 5 >= 3 may win an edit by it.
    """
    return 3 * (words // 5) + np.maximum(0, words % 5 - 2)


def _shared(distinct: DataFrame, counts: DataFrame, sampled: bool) -> DataFrame:
    """(part, k): the least frequent shared pieces of each line that can have a partner, as many as it takes to lose none.

    Frequencies are those of the pieces' places, the same for all lines, which is what the order needs. A piece that only seems to
    be shared takes a place too many, and goes when blocks are counted.
    """
    sent = distinct.sparkSession.sparkContext.broadcast(_filters(counts))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, levels = sent.value
        for keys, n, line, part in _pieces(batches, sampled):
            bit = part >> (PART_BITS + 1 - FILTER_BITS.bit_length())
            may = (bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
            # What may be unshared beyond the pieces of now; of short lines and samples any one piece is enough.
            spare = np.where((n < 10) | sampled, 1 << 30, _lost_runs(n) - np.bincount(line, minlength=len(keys)))
            room = np.bincount(line[may], minlength=len(keys)) + spare + 1
            may &= (room > 0)[line]
            line, part = line[may], part[may]
            # By line and level, then by piece, in which order they come.
            order = np.argsort(line.astype(np.uint32) << np.uint32(8) | levels[part >> (PART_BITS + 1 - LEVELS.bit_length())], kind="stable")
            of_line = np.bincount(line, minlength=len(keys))
            rank = np.arange(len(line)) - (np.cumsum(of_line) - of_line)[line]
            take = order[rank < room[line]]
            yield pa.RecordBatch.from_arrays([pa.array(part[take]), pa.array(keys[line[take]])], ["part", "k"])

    rare = settle(distinct.select("k", "norm").mapInArrow(rows, "part long, k long"), "line-prefix")
    sent.destroy()
    return rare


def _joined(words: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each row of word hashes, in order."""
    out = np.full(len(words), seed, np.uint64)
    for column in words.T:
        out = _mixed(out * np.uint64(0xD1342543DE82EF95) + column)
    return out


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Words]]:
    """Keys and words of (k, norm), some lines at a time."""
    for batch in batches:
        keys, norms = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        for a, b in _slices(norms):
            yield keys[a:b], Words(norms[a:b])


def _some(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """The lines whose ``k`` is among the keys, and a few others that their Bloom filter lets pass: no line is shuffled."""
    wanted = keys.select("k").distinct()
    number = wanted.count()
    return lines.filter(might_hold(key_filter(wanted, number), number, F.col("k")))


def _refined(hot: DataFrame, distinct: DataFrame) -> DataFrame:
    """(part, k): rows of frequent blocks, each block joined with its lines' rarest words."""
    lines = settle(_some(distinct.select("k", "norm"), hot), "line-hot")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for _, words in _words_of(batches):
            line, x = words.text, words.hash
            order = np.lexsort((x, line))
            line, x = line[order], x[order]
            new = np.ones(len(x), bool)
            new[1:] = (x[1:] != x[:-1]) | (line[1:] != line[:-1])
            total += np.bincount((x[new] & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        yield from state_rows(total)

    many = summed_states(lines.mapInArrow(counted, STATE_SCHEMA), COUNTERS)

    # One byte a place, a fixed number of them: 0 for no line, 1 for one, more by the logarithm.
    levels = np.where(many <= 1, many, np.minimum(255, 1 + np.floor(8 * np.log2(np.maximum(many, 1))))).astype(np.uint8)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, words in _words_of(batches):
            level = levels[(words.hash & np.uint64(COUNTERS - 1)).astype(np.int64)]
            known = np.flatnonzero(level > 1)
            known = known[np.lexsort((words.hash[known], level[known], words.text[known]))]
            line, x = words.text[known], words.hash[known]
            of_line = np.bincount(line, minlength=len(keys))
            needed = _edits(words.count) - (words.count - of_line) + 1
            rank = np.arange(len(x)) - (np.cumsum(of_line) - of_line)[line]
            take = rank < needed[line]
            take[1:] &= (x[1:] != x[:-1]) | (line[1:] != line[:-1])
            sizes = np.bincount(line[take], minlength=len(keys))
            rare = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes[sizes > 0])).astype(np.int32), pa.array(x[take].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys[sizes > 0]), rare], ["k", "rare"])

    lines = settle(lines.mapInArrow(rarest, "k long, rare array<long>"), "line-rare")
    rows = split_join(hot, lines, ["k"], "inner")
    return rows.select(F.explode("rare").alias("x"), "part", "k").select(F.xxhash64("part", "x").alias("part"), "k")


def _counted(rows: DataFrame, name: str) -> DataFrame:
    """(part, many): the blocks of more than one line."""
    return settle(rows.groupBy("part").agg(F.count("*").alias("many")).filter("many > 1"), name)


def _distinct_blocks(rows: DataFrame, name: str) -> DataFrame:
    """(part, many): the blocks of more than one line, and of those with the same lines one.

    Equal lines are told by their number, the least and the exclusive or of another hash: for two lines exactly, for more
    by some 128 bits.
    """
    held = rows.groupBy("part").agg(F.count("*").alias("many"), F.min("k").alias("least"), F.bit_xor(F.xxhash64("k")).alias("lines")).filter("many > 1")
    return settle(held.groupBy("many", "least", "lines").agg(F.min("part").alias("part")).select("part", "many"), name)


def _ranked(rows: DataFrame) -> DataFrame:
    """(part, k, before) of (part, k, many): the blocks of the line that come just before this one, from large to small."""
    of_line = Window.partitionBy("k").orderBy(F.desc("many"), "part")
    return settle(rows.select("part", "k", F.collect_list("part").over(of_line.rowsBetween(-BEFORE, -1)).alias("before")), "line-ranked")


def _near() -> Column:
    """Whether a pair's lengths, its words and its SimHashes allow the similarity; no pair that has it is refused.

    ``firm`` has the bits of ``sim`` that were decided by more votes than the edits of any partner can turn, two each. The bits of ``odd0`` and so on stand for equal shares of the letters, set if the line has an odd number of them. A changed word
    turns two bits at most, a word more or less one, so lines of different lengths may differ in so many bits less.
    """
    most = F.floor(F.greatest("n", "n_") * (1 - SIMILARITY) + 1e-9)
    apart = F.abs(F.col("n") - F.col("n_"))
    alike = F.col("sim").bitwiseXOR(F.col("sim_")).bitwiseAND(F.col("firm").bitwiseOR(F.col("firm_"))) == 0
    words = reduce(Column.__add__, [F.bit_count(F.col(c).bitwiseXOR(F.col(c + "_"))) for c in _ODD]) <= 2 * most - apart
    return (apart <= most) & words & alike


def _verified(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) of line hashes whose lines are alike enough."""
    pairs = settle(pairs, "line-pairs")
    letters = settle(_some(sketches.select("k", "letters"), pairs.select(F.explode(F.array("a", "b")).alias("k"))), "line-letters")
    pairs = split_join(pairs, letters.select(F.col("k").alias("a"), F.col("letters").alias("ta")), ["a"], "inner")
    pairs = split_join(pairs, letters.select(F.col("k").alias("b"), F.col("letters").alias("tb")), ["b"], "inner")
    longest = F.greatest(F.length("ta"), F.length("tb"))
    pairs = pairs.withColumn("most", F.floor(longest * (1 - SIMILARITY) + 1e-9).cast("int"))
    # With a threshold, levenshtein only looks at a band and gives -1 beyond it.
    return pairs.filter(F.expr("levenshtein(ta, tb, most) >= 0")).select("a", "b")


def _edits(words: np.ndarray) -> np.ndarray:
    """The edits that lines of so many words may be apart."""
    return np.floor(words * (1 - SIMILARITY) + 1e-9).astype(np.int64)


def _sketched(keys: DataFrame, distinct: DataFrame) -> DataFrame:
    """(k, n, sim, firm, odd0 and so on, letters) of the lines that meet others, and of a few more; a letter is a word's, by hash, so that distances count words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, words in _words_of(batches):
            n, sim, firm = words.count, np.zeros(len(k), np.uint64), np.zeros(len(k), np.uint64)
            for bit in range(64):
                votes = np.add.reduceat((words.hash >> np.uint64(bit)).astype(np.uint8) & 1, words.first, dtype=np.int64)
                sim |= (2 * votes > n).astype(np.uint64) << np.uint64(bit)
                # A partner has n / SIMILARITY words at most, so n // 4 edits.
                firm |= (np.abs(2 * votes - n) > 2 * (n // 4)).astype(np.uint64) << np.uint64(bit)
            bit, share = np.uint64(1) << (words.hash & np.uint64(63)), words.hash >> np.uint64(6) & np.uint64(PARITY - 1)
            odd = [np.bitwise_xor.reduceat(np.where(share == i, bit, np.uint64(0)), words.first) for i in range(PARITY)]
            text = (0x10000 + (words.hash & np.uint64(0xFFFFF))).astype("<u4").tobytes().decode("utf-32-le")
            letters = [text[a:b] for a, b in zip(words.first.tolist(), (words.first + n).tolist())]
            numbers = [pa.array(x.view(np.int64)) for x in (sim, firm, *odd)]
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n.astype(np.int32)), *numbers, pa.array(letters, pa.string())], ["k", "n", "sim", "firm", *_ODD, "letters"])

    return _some(distinct.select("k", "norm"), keys).mapInArrow(sketch, "k long, n int, sim long, firm long, " + "".join(f"{c} long, " for c in _ODD) + "letters string")


def _tested(x: np.ndarray, y: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of places x and y that pass the test of :func:`_near`."""
    n, sim, firm, *odd = rows
    for cheap in (True, False):
        most = np.floor(np.maximum(n[x], n[y]) * (1 - SIMILARITY) + 1e-9).astype(np.int64)
        apart = np.abs(n[x] - n[y])
        if cheap:
            ok = (apart <= most) & ((sim[x] ^ sim[y]) & (firm[x] | firm[y]) == 0)
        else:
            ok = sum(np.bitwise_count(c[x] ^ c[y]).astype(np.int64) for c in odd) <= 2 * most - apart
        x, y = x[ok], y[ok]
    return x, y


def _whole_blocks(batches: Iterator[pa.RecordBatch], sketches: int) -> Iterator[list[np.ndarray]]:
    """Columns of rows that are sorted by their first column, cut where it changes; the last ``sketches`` are of bits."""
    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            some = [c.to_numpy() for c in batch.columns]
            some[-sketches:] = [c.view(np.uint64) for c in some[-sketches:]]
            held = [np.concatenate(x) for x in zip(held, some)] if held else some
            last = int(np.searchsorted(held[0], held[0][-1]))
            if last:
                yield [c[:last] for c in held]
                held = [c[last:] for c in held]
    if held:
        yield held


def _ends(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the block of each row begins and ends."""
    edge = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    size = np.diff(np.append(edge, len(part)))
    return np.repeat(edge, size), np.repeat(edge + size, size)


def _met(near: DataFrame) -> DataFrame:
    """(a, b, star): pairs of lines of a block that pass the test of :func:`_near`, each once.

    ``star`` has those of a block's least line and, ``PIVOTS`` times, of the least line that is not near one of these. The others come from blocks of ``HOT`` lines at most. Rows of a block stand together: each is held against the next
    one, the one after that, and so on.
    """

    def found(part: np.ndarray, k: np.ndarray, *rows: np.ndarray) -> pa.RecordBatch:
        begin, end = _ends(part)
        pairs = []
        i, step = np.flatnonzero(end - begin <= HOT), 0
        while len(i):
            step += 1
            i = i[end[i] > i + step]
            pairs.append(_tested(i, i + step, rows))
        stars = []
        i, left = np.arange(len(part)), np.ones(len(part), bool)
        for _ in range(1 + PIVOTS):
            if not len(i):
                break
            # The least of the lines that are left in each block leads.
            new = np.append(True, part[i[1:]] != part[i[:-1]])
            lead = np.repeat(i[new], np.diff(np.append(np.flatnonzero(new), len(i))))
            i, lead = i[~new], lead[~new]
            x, y = _tested(lead, i, rows)
            stars.append((x, y))
            left[y] = False
            i = i[left[i]]
        x, y = (np.concatenate(c) for c in zip(*stars, *pairs))
        star = np.arange(len(x)) < sum(len(c) for c, _ in stars)
        return pa.RecordBatch.from_arrays([pa.array(k[x]), pa.array(k[y]), pa.array(star)], ["a", "b", "star"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_blocks(batches, 2 + PARITY):
            yield found(*columns)

    near = near.select("part", "k", "n", "sim", "firm", *_ODD).repartition("part").sortWithinPartitions("part", "k")
    return near.mapInArrow(rows, "a long, b long, star boolean").groupBy("a", "b").agg(F.max("star").alias("star"))


def _met_apart(near: DataFrame) -> DataFrame:
    """(a, b): the pairs of lines of a block that are in other groups ``c`` and pass the test of :func:`_near`, each once."""

    def found(part: np.ndarray, k: np.ndarray, c: np.ndarray, *rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        begin, end = _ends(part)
        out = np.flatnonzero(c != c[begin])
        # A line outside the group of the block's least line, against all; places of some lines at a time, bounded by their number.
        size, done = end[out] - begin[out], 0
        within = np.ones(len(part), bool)
        within[out] = False
        while done < len(out):
            upto = max(done + 1, int(np.searchsorted(np.cumsum(size[done : done + TESTED]), TESTED, "right")) + done)
            some, many = out[done:upto], size[done:upto]
            x = np.repeat(some, many)
            y = np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many) + begin[x]
            other = (within[y] | (y > x)) & (c[x] != c[y])
            x, y = _tested(x[other], y[other], rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(k[x], k[y])), pa.array(np.maximum(k[x], k[y]))], ["a", "b"])
            done = upto

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_blocks(batches, 2 + PARITY):
            yield from found(*columns)

    near = near.select("part", "k", "c", "n", "sim", "firm", *_ODD).repartition("part").sortWithinPartitions("part", "k")
    return near.mapInArrow(rows, "a long, b long").distinct()


def fuzzy_links(distinct: DataFrame, sampled: bool = False) -> DataFrame:
    """(node, component) of the distinct lines that link with another one."""
    pieces = _piece_counts(distinct, sampled)
    rare = _shared(distinct, pieces, sampled)
    discard(pieces)
    counts = _distinct_blocks(rare, "line-blocks")
    shared = settle(split_join(rare, counts, ["part"], "inner").select("part", "k", "many"), "line-meeting")
    discard(rare, counts)
    rows = shared.filter(F.col("many") <= PAIRED)
    hot = shared.filter(F.col("many") > PAIRED)
    large = None
    if spread := not hot.isEmpty():
        refined = settle(_refined(hot.select("part", "k"), distinct), "line-refined")
        counts = _distinct_blocks(refined, "line-refined-blocks")
        whole, refined = refined, settle(split_join(refined, counts, ["part"], "inner").select("part", "k", "many"), "line-refined-meeting")
        discard(whole, counts)
        rows = rows.unionByName(refined.filter(F.col("many") <= PAIRED))
        large = refined.filter(F.col("many") > PAIRED)
        large = None if large.isEmpty() else large
    sketch = ["n", "sim", "firm", *_ODD]
    sketches = settle(_sketched(rows if large is None else rows.unionByName(large), distinct), "line-sketches")
    met = settle(_met(split_join(rows, sketches.drop("letters"), ["k"], "inner")), "line-met")
    pairs = met.filter("star").select("a", "b")
    if large is not None:
        near = split_join(_ranked(large), sketches.drop("letters"), ["k"], "inner")
        near = settle(near.select("part", "k", "before", *sketch), "line-near")
        least = near.groupBy("part").agg(F.min("k").alias("k_"), *[F.min_by(c, "k").alias(c + "_") for c in sketch])
        stars = split_join(near, least, ["part"], "inner").filter((F.col("k") != F.col("k_")) & _near())
        pairs = pairs.union(stars.select(F.col("k_").alias("a"), F.col("k").alias("b"))).distinct()
    links = settle(_verified(pairs, sketches), "line-stars")
    first = settle(components(links), "line-first").withColumnRenamed("node", "k")
    rest = _apart(met.filter("NOT star").select("a", "b"), first).select("a", "b")
    grouped_rows = split_join(rows.filter(F.col("many") > HOT), sketches.drop("letters"), ["k"], "inner")
    grouped_rows = split_join(grouped_rows, first, ["k"]).withColumn("c", F.coalesce("component", "k"))
    rest = rest.union(_met_apart(grouped_rows)).distinct()
    if large is not None:
        more, pairs = _large(near, first, sketches)
        links = links.union(more)
        rest = rest.union(pairs).distinct()
    rest = settle(_spoken(_apart(rest, first)), "line-spoken")
    links = links.union(settle(_verified(rest.filter("spoken").select("a", "b"), sketches), "line-more"))
    later = settle(components(links), "line-first").withColumnRenamed("node", "k")
    rest = _apart(rest.filter("NOT spoken").select("a", "b"), later).select("a", "b")
    groups = components(links.union(settle(_verified(rest, sketches), "line-rest")))
    discard(shared, sketches, met, links, *([refined] if spread else []))
    return groups


def _apart(pairs: DataFrame, first: DataFrame) -> DataFrame:
    """(a, b, ca, cb): the pairs with the groups of both ends, unless these are the same. A line without a group is its own."""
    group = first.select(F.col("k").alias("a"), F.col("component").alias("ca"))
    ends = split_join(pairs, group, ["a"]).withColumn("ca", F.coalesce("ca", "a"))
    ends = split_join(ends, group.toDF("b", "cb"), ["b"]).withColumn("cb", F.coalesce("cb", "b"))
    return ends.filter("ca <> cb")


def _spoken(pairs: DataFrame) -> DataFrame:
    """(a, b, spoken): whether a pair is one of the least line, among the pairs, of either group; these are measured first."""
    ends = pairs.select(F.col("ca").alias("c"), F.col("a").alias("k")).union(pairs.select("cb", "b"))
    least = ends.groupBy("c").agg(F.min("k").alias("s"))
    marked = split_join(pairs, least.toDF("ca", "sa"), ["ca"], "inner")
    marked = split_join(marked, least.toDF("cb", "sb"), ["cb"], "inner")
    return marked.select("a", "b", ((F.col("a") == F.col("sa")) | (F.col("b") == F.col("sb"))).alias("spoken"))


def _large(near: DataFrame, first: DataFrame, sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of blocks of more than ``PAIRED`` lines, whose least lines' links are in ``first``: more links, and the pairs that are left to be verified."""
    more = None
    ungrouped, near = near, split_join(near, first, ["k"]).withColumn("c", F.coalesce("component", "k")).drop("component")
    near = settle(near, "line-groups")
    discard(ungrouped)
    center = near.groupBy("part").agg(F.min_by("c", "k").alias("center"))
    apart = settle(split_join(near, center, ["part"], "inner").filter(F.col("c") != F.col("center")), "line-apart")
    for _ in range(PIVOTS):
        if apart.isEmpty():
            break
        near, apart, found = _pivoted(near, apart, first, sketches)
        more = found if more is None else more.union(found)
    mixed = near.join(apart.select("part").distinct(), "part", "left_semi")
    right = mixed.select(*[F.col(c).alias(c + "_") for c in near.columns])
    # Lines that are also in one block before this one meet there, or before that.
    met = (F.col("part") == F.col("part_")) & (F.col("c") != F.col("c_")) & ~F.arrays_overlap("before", "before_") & _near()
    pairs = apart.join(right, met).select(F.least("k", "k_").alias("a"), F.greatest("k", "k_").alias("b")).distinct()
    pairs = settle(pairs, "line-mixed")
    discard(near, apart)
    return pairs.limit(0) if more is None else more, pairs


def _pivoted(near: DataFrame, apart: DataFrame, first: DataFrame, sketches: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The least line apart of each block is held against all outside its group and leaves the block, and what links is contracted.

    Returns the blocks that still have lines apart, these lines, and the links found. ``first`` has the groups of the stars,
    by which groups are named; groups that have met since are named by the least of them.
    """
    sketch = ["n", "sim", "firm", *_ODD]
    pivot = settle(apart.groupBy("part").agg(F.min("k").alias("k_"), *[F.min_by(c, "k").alias(c + "_") for c in ["c", *sketch]]), "line-pivots")
    tried = split_join(near, pivot, ["part"], "inner").filter((F.col("c") != F.col("c_")) & _near())
    tried = tried.select(F.least("k", "k_").alias("a"), F.greatest("k", "k_").alias("b")).distinct()
    more = settle(_verified(tried, sketches), "line-more")
    moves = settle(components(_apart(more, first).select("ca", "cb")), "line-moves")

    def moved(rows: DataFrame, column: str) -> DataFrame:
        return split_join(rows, moves.toDF(column, "to"), [column]).withColumn(column, F.coalesce("to", column)).drop("to")

    left = split_join(apart, pivot.select("part", "k_"), ["part"], "inner").filter("k <> k_").drop("k_")
    left = settle(moved(moved(left, "c"), "center").filter(F.col("c") != F.col("center")), "line-apart")
    still = split_join(near, pivot.select("part", "k_"), ["part"], "inner").filter("k <> k_").drop("k_")
    still = settle(moved(still.join(left.select("part").distinct(), "part", "left_semi"), "c"), "line-groups")
    discard(near, apart, pivot, moves)
    return still, left, more


def surplus_lines(docs: DataFrame, min_words: int = MIN_WORDS, sampled: bool = False) -> DataFrame:
    """(doc, tie, places): the places of the lines to leave out, for each document that has any."""
    lines = settle(line_table(docs, min_words), "lines")
    # The first occurrence as one number: document times 2^32 plus place.
    at = F.col("doc").cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col("pos")
    at = at.cast("decimal(38,0)")
    distinct = lines.groupBy("k", "k2").agg(F.min(at).alias("at"), F.min("norm").alias("norm"), F.count("doc").alias("many"))
    distinct = settle(distinct, "line-distinct")
    whole, lines = lines, settle(lines.drop("norm"), "line-places")
    discard(whole)
    groups = fuzzy_links(distinct, sampled)
    joined = distinct.join(groups, distinct["k"] == groups["node"], "left").drop("node").filter("many > 1 OR component IS NOT NULL")
    joined = settle(joined.select("k", "k2", "at", "component"), "line-grouped")
    first = joined.filter("component IS NOT NULL").groupBy("component").agg(F.min("at").alias("first"))
    kept = settle(split_join(joined, first, ["component"]).select("k", "k2", F.coalesce("first", "at").alias("keep")), "line-kept")
    gone = lines.select("doc", "tie", "pos", "k", "k2").join(kept, ["k", "k2"]).filter(at != F.col("keep"))
    return gone.groupBy("doc", "tie").agg(F.collect_list("pos").alias("places"))


def _stripped(docs: DataFrame, min_words: int) -> DataFrame:
    """Documents with their new text, and the lines they had and lost, in columns of the operator's own."""
    gone = settle(surplus_lines(docs, min_words).select(F.col("doc").alias("_ld_doc"), F.col("tie").alias("_ld_tie"), F.col("places").alias("_ld_places")), "line-gone")
    doc, tie = _document()
    df = docs.withColumn("_ld_doc", doc).withColumn("_ld_tie", tie)
    df = df.join(gone, ["_ld_doc", "_ld_tie"], "left")
    text = F.expr("CASE WHEN _ld_places IS NULL THEN text ELSE array_join(filter(split(text, '\\n', -1), (x, i) -> NOT array_contains(_ld_places, i)), '\\n') END")
    df = df.withColumn("_ld_text", text).withColumn("_ld_lines", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)))
    df = df.withColumn("_ld_lines", F.when(F.col("text").isNull(), 0).otherwise(F.col("_ld_lines")))
    df = df.withColumn("_ld_gone", F.when(F.col("_ld_places").isNull(), 0).otherwise(F.size("_ld_places")))
    return df.withColumn("_ld_text", F.when((F.col("_ld_gone") > 0) & ~F.col("_ld_text").rlike(WORD), F.lit("")).otherwise(F.col("_ld_text")))


def dedup_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, lines, lines dropped, and characters and crc32 of the text that stays, for every document."""
    kept = F.coalesce("_ld_text", F.lit(""))
    return _stripped(docs, min_words).select("doc_id", F.col("_ld_lines").cast("long").alias("n_lines"), F.col("_ld_gone").cast("long").alias("n_dropped"), F.length(kept).cast("long").alias("kept_chars"), F.crc32(kept.cast("binary")).alias("kept_crc32"))


def dedup_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents without the surplus lines; those that had words and have none left go. n_chars follows the text."""
    df = _stripped(docs, min_words).filter("_ld_gone = 0 OR _ld_text <> ''").withColumn("text", F.col("_ld_text"))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(F.col("_ld_gone") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return df.select(*docs.columns)
