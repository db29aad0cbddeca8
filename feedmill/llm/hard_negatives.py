"""Hard negatives by the threshold algorithm of Fagin, Lotem and Naor.

Vectors become integers, floor(``SCALE`` * x). Candidates are dealt evenly to shards of ``SHARD_ROWS`` rows; a shard
holds one list of its rows for each dimension, sorted by component. An anchor reads each list from the end that its own
component's sign favours, in steps of ``STEP`` places that double; rows met for the first time are scored by random access, as
integer inner products. The anchors of a block read the lists together: a row that one of them meets is fetched once and
scored for all whose search goes on, which only lets a search see more rows. What the places reached would score together is the threshold: no row not yet met scores more. The search
of a shard ends when, for every window of the anchor, the threshold is strictly below the window's k-th score so far or
below its lower end (ties go to the smaller id, so equality goes on), or when every row was met.

Two searches: the first has one window, the rows of the anchor's label, and finds the positives; the second has a window
for each positive, bounded by its score. Shards' findings are merged by a window function that cuts each task's rows to k
a group before the shuffle. Anchors travel to the shards in packed blocks, and shards stay where they are: every query
vector has to meet every shard, which the stated query set makes part of the task. A score never leaves the integers.

Cases: rows with a null label, a null vector, or a null or non-finite component take no part. Rows that are equal in all
three columns count once; other rows with equal ids are rows of their own. A null id is no anchor and comes last among
equal scores. Vectors meet those of their own length only, empty ones with a score of 0. Scaled components are held within
``BOUND``, so that no sum leaves 64 bits. A positive whose score is not above 0 has no negatives, except that a score of 0 takes
those of 0. An empty table gives no rows. Columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import settle

SCALE = 256
BOUND = 1 << 20
SHARD_ROWS = 8192
ANCHOR_ROWS = 256
STEP = 32
LAST_ID = (1 << 63) - 1


def quantised(vector: str) -> Column:
    """Integer components, or null where the row takes no part."""
    x = F.transform(vector, lambda x: x.cast("double"))
    sound = F.col(vector).isNotNull() & F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    return F.when(sound, F.transform(x, lambda a: F.greatest(F.least(F.floor(F.greatest(F.least(a, F.lit(1e12)), F.lit(-1e12)) * SCALE), F.lit(BOUND)), F.lit(-BOUND)).cast("int")))


class Shard:
    """A shard's rows, and for each dimension their order by component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")  # so that places order equal scores
        self.ids, self.labels, self.vectors = ids[by_id], labels[by_id], vectors[by_id]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(self.vectors, self.lists, 0)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (factor, low, high), which takes scores with low <= factor * score <= high: the first k rows (places, scores)."""
        return self.search_all(anchor[None, :], lambda _: allowed, [windows], k)[0]

    def search_all(self, anchors: np.ndarray, allowed: Callable[[int], np.ndarray], windows: list[list[tuple[int, int, int]]], k: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """The same for several anchors, of which each has windows of its own and rows that are allowed."""
        many = len(self.vectors)
        met = np.zeros(many, bool)
        found = [[(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in own] for own in windows]
        live = np.array([x for x, own in enumerate(windows) if own], np.int64)
        at, step = 0, STEP
        while len(live):
            stop = min(at + step, many)
            asking = anchors[live]
            # Anchor-signed access: from the end where products are largest. A zero adds nothing to any score.
            down, up = (asking > 0).any(0), (asking < 0).any(0)
            new = np.zeros(many, bool)
            new[self.lists[many - stop : many - at, down]] = True
            new[self.lists[at:stop, up]] = True
            if not asking.any(1).all():
                new[:] = True
            rows = np.flatnonzero(new & ~met)
            met[rows] = True
            scored = _products(self.vectors[rows], asking)
            reached = np.maximum(asking, 0) @ self.values[many - stop] + np.minimum(asking, 0) @ self.values[stop - 1]
            ends = np.full(len(live), stop == many or met.all())
            for i, x in enumerate(live.tolist()):
                mine = allowed(x)[rows]
                places, scores = rows[mine], scored[i, mine]
                for w, (factor, low, high) in enumerate(windows[x]):
                    fits = (factor * scores >= low) & (factor * scores <= high)
                    before, marks = found[x][w]
                    if len(marks) == k:
                        fits &= scores >= marks[-1]
                    if fits.any():
                        p, s = np.append(before, places[fits]), np.append(marks, scores[fits])
                        if len(s) > 4 * k:
                            best = s >= np.partition(s, len(s) - k)[len(s) - k]
                            p, s = p[best], s[best]
                        best = np.lexsort((p, -s))[:k]
                        found[x][w] = p[best], s[best]
                threshold = int(reached[i])
                ends[i] |= all(factor * threshold < low or (len(s) == k and threshold < s[-1]) for (factor, low, _), (_, s) in zip(windows[x], found[x]))
            live = live[~ends]
            at, step = stop, 2 * step
        return found


def _products(vectors: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of each anchor with each vector; as doubles where these hold them exactly, which is faster."""
    if not len(vectors):
        return np.zeros((len(anchors), 0), np.int64)
    if int(np.abs(vectors).max()) * int(np.abs(anchors).max()) * vectors.shape[1] < 1 << 53:
        return (anchors.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return anchors @ vectors.T


def _packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows of up to ``size`` vectors of one length: (part, width, many, rids, ids, labels, vectors), numbers as bytes."""
    names = ["width", "many", "rids", "ids", "labels", "vectors"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def emit(width: int) -> pa.RecordBatch:
            rids, ids, labels, vectors = zip(*held.pop(width))
            data = [np.array(x, kind).tobytes() for x, kind in ((rids, "<i8"), (ids, "<i8"), (labels, "<i8"), (vectors, "<i4"))]
            return pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([len(rids)], pa.int32()), *[pa.array([d], pa.binary()) for d in data]], names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                here = held.setdefault(len(row[3]), [])
                here.append(row)
                if len(here) == size:
                    yield emit(len(row[3]))
        for width in list(held):
            yield emit(width)

    packed = rows.select("rid", "id", "label", "q").mapInArrow(run, "width int, many int, rids binary, ids binary, labels binary, vectors binary")
    return settle(packed.withColumn("part", F.spark_partition_id().cast("long")), name)


def _numbers(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rids, ids, labels = (np.frombuffer(row[c], "<i8") for c in ("rids", "ids", "labels"))
    vectors = np.frombuffer(row["vectors"], "<i4").astype(np.int64).reshape(row["many"], row["width"])
    return rids, ids, labels, vectors if row["width"] else np.zeros((row["many"], 1), np.int64)


def _searched(shards: DataFrame, n_shards: int, blocks: DataFrame, k: int, bounds: tuple[int, int, int] | None) -> DataFrame:
    """(anchor, window, id, rid, score, rank): the first k rows of each window of each anchor.

    Without ``bounds`` the one window of an anchor takes all other rows of its label. With (low, high, factor), the
    blocks' column windows lists (anchor, window, score), and a window takes rows of other labels with
    low * score <= factor * s <= high * score. A shard's rows come first to its task, then all blocks of anchors.
    """
    windows = "array<struct<anchor: bigint, window: int, score: bigint>>"
    if bounds is None:
        blocks = blocks.withColumn("windows", F.lit(None).cast(windows))
    stored = shards.select(F.col("part").alias("shard"), F.lit(0).alias("kind"), "*", F.lit(None).cast(windows).alias("windows"))
    sent = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("kind"), "*")
    queue = stored.unionByName(sent.select(*stored.columns)).repartition("shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, number = [], None  # the shards of this number: one, or more of different widths
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)}
                if row["shard"] != number:
                    here, number = [], row["shard"]
                rids, ids, labels, vectors = _numbers(row)
                if row["kind"] == 0:
                    here.append((row["width"], Shard(ids, labels, vectors), rids[np.argsort(ids, kind="stable")]))
                    continue
                wanted: dict[int, list] = {}
                for w in row["windows"] or []:
                    wanted.setdefault(w["anchor"], []).append((w["window"], w["score"]))
                out = [[], [], [], [], []]
                for width, shard, own in here:
                    if width != row["width"]:
                        continue
                    place = {rid: x for x, rid in enumerate(own.tolist())}
                    if bounds is None:
                        named, ranges = [[0]] * len(rids), [[(1, -LAST_ID, LAST_ID)]] * len(rids)
                    else:
                        low, high, factor = bounds
                        asked = [wanted.get(rid, []) for rid in rids.tolist()]
                        named = [[name for name, _ in some] for some in asked]
                        ranges = [[(factor, low * s, high * s) for _, s in some] for some in asked]

                    def allowed(x: int, shard: Shard = shard, place: dict[int, int] = place) -> np.ndarray:
                        if bounds is not None:
                            return shard.labels != labels[x]
                        rows = shard.labels == labels[x]
                        if (itself := place.get(int(rids[x]))) is not None:
                            rows[itself] = False
                        return rows

                    for rid, names, results in zip(rids.tolist(), named, shard.search_all(vectors, allowed, ranges, k)):
                        for name, (places, scores) in zip(names, results):
                            out[0] += [rid] * len(places)
                            out[1] += [name] * len(places)
                            out[2] += shard.ids[places].tolist()
                            out[3] += own[places].tolist()
                            out[4] += scores.tolist()
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], ["anchor", "window", "id", "rid", "score"])

    found = queue.mapInArrow(run, "anchor long, window int, id long, rid long, score long")
    first = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "rid")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    factor: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` says which rows are anchors. A negative's score lies between low and high parts in ``factor`` of the
    positive's.
    """
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    rows = vectors.select(ids.alias("id"), F.col(label_col).cast("long").alias("label"), quantised(vector_col).alias("q"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    rows = rows.filter("label IS NOT NULL AND q IS NOT NULL").distinct()
    rows = settle(rows.withColumn("rid", F.monotonically_increasing_id()), "hn-rows")
    count = rows.agg(F.count("*").alias("all"), F.count_if("asks").alias("asks")).first()
    n_shards, n_blocks = max(1, -(-count["all"] // shard_rows)), max(1, -(-count["asks"] // ANCHOR_ROWS))
    shards = _packed(rows.repartition(n_shards), shard_rows, "hn-shards")
    blocks = _packed(rows.filter("asks").repartition(n_blocks), ANCHOR_ROWS, "hn-anchors")
    near = settle(_searched(shards, n_shards, blocks, positives, None), "hn-positives")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, width, rids in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(rids, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(own), pa.int64()), pa.array([width] * len(own), pa.int32()), pa.array(own)], ["part", "width", "anchor"])

    of_blocks = blocks.select("part", "width", "rids").mapInArrow(members, "part long, width int, anchor long")
    windows = near.select("anchor", F.col("rank").alias("window"), "score").join(of_blocks, "anchor")
    windows = windows.groupBy("part", "width").agg(F.collect_list(F.struct("anchor", "window", "score")).alias("windows"))  # a block's anchors, k each
    hard = _searched(shards, n_shards, blocks.join(windows, ["part", "width"]), negatives, (low, high, factor))
    of = near.select("anchor", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = hard.withColumnRenamed("score", "negative_score").withColumnRenamed("id", "negative_id").join(of, ["anchor", "window"])
    out = out.join(rows.filter("asks").select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    anchor, positive, negative = (F.nullif(F.col(c), F.lit(LAST_ID)).alias(c) for c in ("anchor_id", "positive_id", "negative_id"))
    return out.select(anchor, positive, F.col("rank").cast("int").alias("rank"), negative, "positive_score", "negative_score")
