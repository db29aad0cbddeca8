"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words. A span of ``window`` words (an item of fewer words: all of them) has
``window - k + 1`` k-grams of ``k`` words; of these the least hash is kept, the last of equals. Whatever spans two texts
share, they keep the same fingerprint in each of its windows, so a join on fingerprints meets every shared span. Hits are
extended: all windows around a matching fingerprint are looked up among the items' windows, text by text, and the windows
found are united to spans of words.

Two passes bound the work. Items' fingerprints set bits in a filter of fixed size (``FILTER_BITS``), which every task
gets; documents' fingerprints that meet no bit can match none and are not written. A full filter costs time, not results.
Fingerprints and windows of items stand once each on the right of their joins, and the left sides, where a passage may be
frequent, can be split. Items with the same windows are one until the last join.

Cases: null, empty and texts without words have no words, windows or hits; an item without words is never found; very long
texts count whole; repeated rows give repeated results, and rows with equal id and different texts are told apart; items
with equal id count once; null item ids are not listed. An empty benchmark leaves every document clean. Columns of other
names are not read, and the operator's own begin with ``_wn_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import settle, split_join

WINDOW = 10
#: Bits of the filter; its size is the bound of what is sent to every task (1 MB).
FILTER_BITS = 1 << 23
#: Bytes of text that are hashed at a time.
PIECE = 1 << 21
#: Fixed value: letters of words, in lower case; all other bytes below 128 part words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts: where they are in the joined bytes, their hashes, and the text of each."""

    def __init__(self, texts: list[str]):
        parts = [t.encode().translate(_WORD_BYTES) for t in texts]
        self.data = b" ".join(parts) + b" "
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        inside = np.frombuffer(self.data, np.uint8) != 32
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.start, self.end = edges[::2], edges[1::2]
        self.text = np.searchsorted(np.cumsum(sizes), self.start, "right")
        self.count = np.bincount(self.text, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Polynomial hashes of the words, from prefix sums; a piece of whole words at a time."""
        out = np.zeros(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):
            begin = int(self.start[at])
            stop = max(at + 1, int(np.searchsorted(self.end, begin + PIECE, "right")))
            some = np.frombuffer(self.data, np.uint8, int(self.end[stop - 1]) - begin, begin).astype(np.uint64)
            total = np.zeros(len(some) + 1, np.uint64)
            np.cumsum((some + np.uint64(1)) * _table(_BASE, len(some)), out=total[1:])
            a, b = self.start[at:stop] - begin, self.end[at:stop] - begin
            out[at:stop] = (total[b] - total[a]) * _table(pow(_BASE, -1, 1 << 64), len(some))[a]
            at = stop
        return _mixed(out)

    def grams(self, k: int) -> np.ndarray:
        """The hash of the k words from each place on, over the ends of texts too."""
        many = max(len(self.hash) - k + 1, 0)
        out = np.zeros(many, np.uint64)
        for j in range(k):
            out = out * np.uint64(0xD1342543DE82EF95) + self.hash[j : j + many]
        return _mixed(out)

    def whole(self, span: int) -> np.ndarray:
        """Whether the ``span`` words from each place on lie within a text."""
        many = max(len(self.hash) - span + 1, 0)
        return self.text[:many] == self.text[span - 1 : span - 1 + many]

    def words(self, at: int, span: int) -> str:
        """The words from a place on, joined by single spaces."""
        return b" ".join(self.data[self.start[at] : self.end[at + span - 1]].split()).decode()


_TABLES: dict[int, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    if base not in _TABLES or len(_TABLES[base]) < n:
        _TABLES[base] = _powers(base, max(n, PIECE))
    return _TABLES[base][:n]


def gram_words(span: int) -> int:
    """Words of a k-gram: half a window, so that a window keeps one of about as many fingerprints."""
    return (span + 1) // 2


def fingerprints(words: Words, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the k-grams that winnowing keeps for windows of ``span`` words."""
    k = gram_words(span)
    grams, whole = words.grams(k), words.whole(span)
    if not len(whole):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least, place = grams[: len(whole)].copy(), np.arange(len(whole))
    for j in range(1, span - k + 1):
        here = grams[j : j + len(whole)]
        better = here <= least  # the last of equals
        least[better] = here[better]
        place[better] = np.flatnonzero(better) + j
    kept = np.unique(place[whole])
    return kept, grams[kept]


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about a piece together; a longer text is a run of its own."""
    begin, size = 0, 0
    for k, text in enumerate(texts):
        more = len(text or "")
        if k > begin and size + more > PIECE:
            yield begin, k
            begin, size = k, 0
        size += more
    if begin < len(texts):
        yield begin, len(texts)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def item_windows(bench: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, span, window, words, grams): the items' windows, with the fingerprints that lie within."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _slices(texts):
                words = Words([t or "" for t in texts[a:b]])
                for span in sorted({min(int(n), window) for n in words.count} - {0}):
                    mine = (words.count >= window) if span == window else (words.count == span)
                    k = gram_words(span)
                    kept, _ = fingerprints(words, span)
                    hashes, grams = words.grams(span), words.grams(k)
                    at = [p for p in np.flatnonzero(words.whole(span)).tolist() if mine[words.text[p]]]
                    within = [grams[kept[np.searchsorted(kept, p) : np.searchsorted(kept, p + span - k, "right")]].view(np.int64).tolist() for p in at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[a + words.text[p]] for p in at], pa.string()), pa.array([span] * len(at), pa.int32()), _signed(hashes[at]), pa.array([words.words(p, span) for p in at], pa.string()), pa.array(within, pa.list_(pa.int64()))],
                        ["item", "span", "window", "words", "grams"],
                    )

    source = bench.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "item string, span int, window long, words string, grams array<long>")


def _filter_of(windows: DataFrame) -> np.ndarray:
    """Which bits the items' fingerprints set, as packed bytes; a row of 4 kB for each 32,768 bits reaches the driver."""
    grams = windows.select(F.explode("grams").alias("gram"))
    bits = grams.select(F.shiftrightunsigned("gram", 65 - FILTER_BITS.bit_length()).alias("bit")).withColumn("slice", F.shiftright("bit", 15))
    rows = bits.groupBy("slice").agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(32767))).alias("bits")).collect()
    out = np.zeros((FILTER_BITS >> 15, 4096), np.uint8)
    for row in rows:
        out[row["slice"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out.ravel()


def document_hits(docs: DataFrame, spans: list[int], bits: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, _wn_row, n_words, found): for each fingerprint that may match, its hash and the windows around it."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    around = pa.struct([("at", pa.int32()), ("window", pa.int64()), ("words", pa.string())])
    one = pa.struct([("span", pa.int32()), ("gram", pa.int64()), ("around", pa.list_(around))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, row = sent.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _slices(texts):
                words = Words([t or "" for t in texts[a:b]])
                found: list[list[dict]] = [[] for _ in range(b - a)]
                for span in spans:
                    k = gram_words(span)
                    kept, grams = fingerprints(words, span)
                    bit = (grams >> np.uint64(65 - FILTER_BITS.bit_length())).astype(np.int64)
                    may = np.flatnonzero(bitmap[bit >> 3] >> (bit & 7) & 1)
                    if not len(may):
                        continue
                    windows, whole = words.grams(span), words.whole(span)
                    for p, gram in zip(kept[may].tolist(), grams[may].view(np.int64).tolist()):
                        text, ats = words.text[p], [s for s in range(max(p - span + k, 0), min(p + 1, len(whole))) if whole[s] and words.text[s] == words.text[p]]
                        found[text].append({"span": span, "gram": gram, "around": [{"at": s - int(words.first[text]), "window": int(windows[s].view(np.int64)), "words": words.words(s, span)} for s in ats]})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.arange(row, row + b - a)), pa.array(words.count, pa.int64()), pa.array(found, pa.list_(one))],
                    ["doc_id", "_wn_row", "n_words", "found"],
                )
                row += b - a

    kind = docs.schema[id_col].dataType.simpleString()
    found = "array<struct<span: int, gram: bigint, around: array<struct<at: int, window: bigint, words: string>>>>"
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return df.mapInArrow(run, f"doc_id {kind}, _wn_row long, n_words long, found {found}")


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, spans (first word, words; apart from one another) and items (sorted ids) of every document."""
    windows = settle(item_windows(bench, window, item_col, text_col), "wn-items")
    spans = [r["span"] for r in windows.select("span").distinct().collect()]  # ``window`` numbers at most
    scanned = settle(document_hits(docs, sorted(spans), _filter_of(windows), id_col, text_col), "wn-documents")
    marks = windows.select("span", F.explode("grams").alias("gram")).distinct()
    found = scanned.select("_wn_row", F.explode("found").alias("f")).select("_wn_row", "f.span", "f.gram", "f.around")
    found = split_join(found, marks, ["span", "gram"], "inner")
    around = found.select("_wn_row", "span", F.explode("around").alias("w")).select("_wn_row", "span", "w.at", "w.window", "w.words").distinct()
    known = windows.select("span", "window", "words").distinct()
    hits = settle(split_join(around, known, ["span", "window", "words"], "inner"), "wn-hits")
    # A document's starts are no more than its words.
    starts = hits.groupBy("_wn_row").agg(F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("span")).alias("end")))).alias("s"))
    none = "cast(array() AS array<struct<at: int, end: int>>)"
    joined = (
        f"aggregate(s, {none}, (a, x) -> CASE WHEN size(a) > 0 AND x.at <= element_at(a, -1).end THEN concat(slice(a, 1, size(a) - 1), "
        "array(named_struct('at', element_at(a, -1).at, 'end', greatest(element_at(a, -1).end, x.end)))) ELSE concat(a, array(x)) END)"
    )
    starts = starts.select("_wn_row", F.expr(joined).alias("s"))
    # Items with the same windows are one class.
    texts = windows.groupBy("item").agg(F.xxhash64(F.array_sort(F.collect_set("words"))).alias("class"), F.min("words").alias("least"))
    classes = settle(windows.select("item", "span", "window", "words").distinct().join(texts, "item"), "wn-classes")
    members = classes.filter("item IS NOT NULL").select("class", "least", "item").distinct()
    of = classes.select("span", "window", "words", "class", "least").distinct()
    met = hits.select("_wn_row", "span", "window", "words").distinct().join(of, ["span", "window", "words"]).select("_wn_row", "class", "least").distinct()
    items = met.join(members, ["class", "least"]).groupBy("_wn_row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    per_row = settle(starts.join(items, "_wn_row", "left"), "wn-rows")
    out = scanned.select("doc_id", "_wn_row", "n_words").join(per_row, "_wn_row", "left")
    spans_of = F.expr(f"transform(coalesce(s, {none}), x -> named_struct('first', x.at, 'words', x.end - x.at))")
    return out.select("doc_id", "n_words", spans_of.alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
