"""SimHash near-duplicates: fingerprints of 3-word shingles, linked by BK-tree searches.

A fingerprint is a 64-bit vote of the XXH64 hashes of a text's shingles. Two of them link at ``RADIUS`` or fewer
differing bits. Five blocks of bits of which three can differ leave two whole, so each distinct fingerprint goes to
the ten shards that pairs of blocks name, and fingerprints that link meet in one of them. A shard with more than
``TREE_ROWS`` fingerprints has several BK-trees, and every one of its query blocks gets every one of its trees; trees
travel with the rows of a shuffle and not through the driver, as fingerprints may not be collected there. A search
follows only edges within the radius, and a task passes on a spanning forest of the links that it finds.

Cases: null text, empty text and text without words have the fingerprint zero and link like any other; fewer than
three words are one shingle; repeated rows and ties link at distance 0; a null ``doc_id`` is kept with its fingerprint
and gets its group's least id. An empty table gives an empty result. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .shared import settle, split_join

RADIUS = 3
SEED = 42
TREE_ROWS = 128
_BLOCKS = (13, 13, 13, 13, 12)
_VOTE_ROWS = 1 << 16


def shingle_hashes(text: bytes, words: int = 3) -> list[int]:
    """Hashes of all shingles of a text, repeats included. bytes.lower and bytes.split know ASCII only."""
    split = text.lower().split()
    if not split:
        return []
    digest = xxhash.xxh64_intdigest
    if len(split) < words:
        return [digest(b" ".join(split), SEED)]
    join = b" ".join
    return [digest(join(s), SEED) for s in zip(*(split[k:] for k in range(words)))]


def fingerprint(text: bytes) -> int:
    """The vote of a text's shingles, bit by bit."""
    hashes = np.array(shingle_hashes(text), np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _VOTE_ROWS):
        part = hashes[at : at + _VOTE_ROWS].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """Distinct integers by Hamming distance: a child hangs on the edge numbered by its distance to its parent."""

    def __init__(self, values: list[int]):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        for k in range(1, len(values)):
            at = 0
            while True:
                distance = (values[k] ^ values[at]).bit_count()
                below = self.children[at].get(distance)
                if below is None:
                    self.children[at][distance] = k
                    break
                at = below

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of all values at most ``radius`` bits from a value."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (value ^ self.values[at]).bit_count()
            if distance <= radius:
                found.append(at)
            todo += [child for edge, child in self.children[at].items() if distance - radius <= edge <= distance + radius]
        return found


def _shard_links(rows: list[tuple[int, int, bool, bool]], radius: int) -> Iterator[tuple[int, int]]:
    """A forest of the links between a shard's tree rows and its query rows, as pairs of ids."""
    tree_rows = [r for r in rows if r[2]]
    queries = [r for r in rows if r[3]]
    mask = (1 << 64) - 1
    tree = BKTree([r[0] & mask for r in tree_rows])
    place: dict[int, int] = {}
    for r in rows:
        place.setdefault(r[1], len(place))
    forest = Forest(len(place))
    for fp, rep, *_ in queries:
        for k in tree.within(fp & mask, radius):
            other = tree_rows[k][1]
            if other != rep and forest.join(place[rep], place[other]):
                yield rep, other


def link_fingerprints(distinct: DataFrame, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Edges (a, b) that connect all of (fp, rep) whose fingerprints lie within the radius; radius 3 at most."""
    if radius > 3:
        raise ValueError("five blocks of which two stay whole find distances up to 3")
    ends = np.cumsum(_BLOCKS)
    parts = [((1 << int(e)) - (1 << int(e - w))) for e, w in zip(ends, _BLOCKS)]
    masks = [a | b for a, b in combinations(parts, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = distinct.select("fp", "rep", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for k, m in enumerate(signed)])).alias("s"))
    keyed = keyed.select("fp", "rep", "s.k", "s.part")
    shared = keyed.groupBy("k", "part").agg(F.count("fp").alias("n")).filter("n > 1")
    rows = split_join(keyed, shared, ["k", "part"], "inner").withColumn("trees", F.ceil(F.col("n") / tree_rows).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp", F.lit("tree")), F.col("trees")).cast("int"))
    units = F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("other")
    rows = rows.select("k", "part", "fp", "rep", "own", units)
    # A block of queries meets its own tree and those of later blocks.
    as_query = rows.filter("other >= own").select("k", "part", F.col("other").alias("tree"), F.col("own").alias("block"), "fp", "rep", (F.col("other") == F.col("own")).alias("in_tree"), F.lit(True).alias("asks"))
    as_tree = rows.filter("other < own").select("k", "part", F.col("own").alias("tree"), F.col("other").alias("block"), "fp", "rep", F.lit(True).alias("in_tree"), F.lit(False).alias("asks"))
    dealt = as_query.union(as_tree).repartition("k", "part", "tree", "block").sortWithinPartitions("k", "part", "tree", "block", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        found: list[tuple[int, int]] = []
        for _, group in groupby(stream(), key=lambda r: r[:4]):
            found += _shard_links([r[4:] for r in group], radius)
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the least doc_id reachable over links."""
    fps = settle(fingerprints(docs, id_col, text_col), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    # Fingerprints that only rows without an id have cannot be named in an edge.
    groups = components(link_fingerprints(distinct.filter("rep IS NOT NULL"), radius))
    classes = distinct.join(groups, distinct["rep"] == groups["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return split_join(fps, classes, ["fp"]).select("doc_id", "fp", "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id is their group's least; rows without an id stay. All columns are kept as they are."""
    groups = simhash_groups(docs, id_col, text_col)
    gone = settle(groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "simhash-gone")
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
