"""Embedding near-duplicates by search on a robust-pruned flat graph.

Centroids from a bounded sample (``SAMPLE``) cut the vectors into overlapping clusters: each vector belongs to its
``OVERLAP`` nearest ones. A cluster is dealt into shards of about ``SHARD_ROWS`` vectors; each shard builds its part of
the graph, a pruned list of neighbours for each vector, and the lists of a vector's shards are united. Every block of a
cluster's vectors searches every shard of the cluster: from the shard's medoids, greedily, with ``BEAM`` candidates, and
on from every vector within the range until no further one is found. All links are verified by cosine in double
precision; a task emits link counts and a spanning forest of links, never the links themselves. A pair that meets in
several clusters counts in the first. The recall of audited vectors that have links is measured against all vectors;
if its mean is below ``LEAST_RECALL``, clusters overlap more and the beam is widened, and if it is below
``CONTRACT_RECALL`` at the end, the operator fails.

Cases: null vectors, vectors with null, NaN or infinite components, empty and zero vectors link with nothing; vectors of
each length are a graph of their own; rows that repeat an id count once (the least vector by hash); equal vectors link;
rows with a null id are left out; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .shared import settle

THRESHOLD = 0.95
SAMPLE = 16_384
CLUSTER_ROWS = 500
MOST_CLUSTERS = 512
OVERLAP = 2
SHARD_ROWS = 1024
DEGREE = 24
POOL = 64
LONG_EDGES = 3
MEDOIDS = 48
ALPHA = 1.2
BEAM = 48
#: Vectors with links that an audit wants, and the vectors it looks at for them, at most.
AUDIT_LINKED, MOST_AUDITED = 50, 3200
#: Below this mean recall a result is not given.
CONTRACT_RECALL = 0.9
AUDITED = 200
LEAST_RECALL = 0.93


def clean_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): one row per id; v is null unless the vector can link."""
    v = F.col(vector_col).cast("array<double>")
    norm = F.expr("aggregate(v, 0D, (s, x) -> s + x * x)")
    df = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL")
    df = df.withColumn("v", F.when(F.expr("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"), F.col("v")))
    df = df.withColumn("v", F.when((norm > 0) & (norm < float("inf")), F.col("v")))
    return df.groupBy("vec_id").agg(F.min_by("v", F.struct(F.col("v").isNull(), F.xxhash64("v"))).alias("v"))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def train_centroids(sample: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means."""
    random = np.random.default_rng(5)
    centres = sample[random.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        nearest = np.argmax(sample @ centres.T, 1)
        for j in range(k):
            own = sample[nearest == j]
            if len(own):
                centres[j] = own.mean(0)
        norm = np.linalg.norm(centres, axis=1, keepdims=True)
        centres = centres / np.where(norm == 0, 1, norm)
    return centres


def robust_prune(x: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = ALPHA) -> np.ndarray:
    """Neighbour lists (padded with -1): of the nearest, those that no kept neighbour is much nearer to.

    The candidates are the nearest ``pool`` vectors of the shard. A few edges at random lead out of dense groups, whose
    members would else know only each other; back edges are added where there is room.
    """
    n = len(x)
    random = np.random.default_rng(9)
    near = x @ x.T
    np.fill_diagonal(near, -np.inf)
    m = min(pool, n - 1)
    if m <= 0:
        return np.full((n, degree), -1)
    nearest = np.argpartition(-near, m - 1, axis=1)[:, :m]
    away = random.integers(0, n, (n, LONG_EDGES))
    lists, used = np.full((n, degree), -1), np.zeros(n, int)
    for k in range(n):
        own = nearest[k]
        own = own[np.argsort(-near[k, own], kind="stable")]
        far = 1 - near[k, own]
        alive, kept = np.ones(len(own), bool), 0
        between = 1 - near[np.ix_(own, own)]
        for j in range(len(own)):
            if alive[j]:
                lists[k, kept] = own[j]
                kept += 1
                if kept == degree - 8 - LONG_EDGES:
                    break
                alive &= alpha * between[j] > far
        lists[k, kept : kept + LONG_EDGES] = np.where(away[k] == k, -1, away[k])
        kept += LONG_EDGES
        used[k] = kept
    for k in range(n):
        for j in lists[k, : used[k] - LONG_EDGES]:
            if used[j] < degree and k not in lists[j]:
                lists[j, used[j]] = k
                used[j] += 1
    return lists


def medoids(x: np.ndarray, count: int = MEDOIDS) -> list[int]:
    """The vector nearest to the mean, then each time the one farthest from all so far."""
    chosen = [int(np.argmax(x @ x.mean(0)))]
    near = x @ x[chosen[0]]
    while len(chosen) < min(count, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    return chosen


def range_search(queries: np.ndarray, x: np.ndarray, lists: np.ndarray, threshold: float, beam: int) -> np.ndarray:
    """Boolean (query, vector): all vectors within the range that the search reaches. All queries advance together."""
    q, n = len(queries), len(x)
    seen = np.full((q, n), -2.0)
    grown = np.zeros((q, n), bool)

    def visit(rows: np.ndarray, nodes: np.ndarray) -> None:
        """Look at the neighbours of some (query, node)."""
        grown[rows, nodes] = True
        to = lists[nodes]
        rows = np.repeat(rows, to.shape[1])
        to = to.ravel()
        new = (to >= 0) & (seen[rows, np.maximum(to, 0)] < -1.5)
        pair = np.unique(rows[new].astype(np.int64) * n + to[new])
        rows, to = pair // n, pair % n
        for at in range(0, len(rows), 200_000):
            a, b = rows[at : at + 200_000], to[at : at + 200_000]
            seen[a, b] = np.einsum("ij,ij->i", queries[a], x[b])

    entries = medoids(x)
    seen[:, entries] = queries @ x[entries].T
    live = np.arange(q)
    for _ in range(n):
        part = seen[live]
        bar = -np.partition(-part, beam - 1, axis=1)[:, beam - 1] if n > beam else np.full(len(live), -2.0)
        open_ = np.where(grown[live] | (part < -1.5), -3.0, part)
        best = np.argmax(open_, 1)
        value = open_[np.arange(len(live)), best]
        go = (value > -1.5) & (value >= bar)
        live, best = live[go], best[go]
        if not len(live):
            break
        visit(live, best)
    while True:
        rows, nodes = np.nonzero((seen >= threshold - 0.02) & ~grown)
        if not len(rows):
            return seen >= threshold
        visit(rows, nodes)


def _streamed(batches: Iterator[pa.RecordBatch], keys: int):
    """Rows of sorted batches, group by group."""

    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    return groupby(rows(), key=lambda r: r[:keys])


def _vectors(rows: list[tuple], at: int) -> np.ndarray:
    return np.array([np.frombuffer(r[at]) for r in rows])


def _links(usable: DataFrame, n: int, threshold: float, overlap: int, beam: int) -> DataFrame:
    """Rows of (kind, a, b): kind 0 a vector and its links, kind 1 an edge of a forest of links."""
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    x = _unit(np.array([r["v"] for r in sample]))
    centroids = train_centroids(x, max(1, min(MOST_CLUSTERS, n // CLUSTER_ROWS, len(x))))
    overlap = min(overlap, len(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _unit(np.array(batch.column(1).to_pylist(), np.float64))
                cells = np.sort(np.argsort(-(v @ centroids.T), axis=1, kind="stable")[:, :overlap], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells.tolist(), pa.list_(pa.int32())), pa.array([r.tobytes() for r in v], pa.binary())], ["vec_id", "cells", "v"])

    members = usable.mapInArrow(assign, "vec_id long, cells array<int>, v binary").withColumn("cell", F.explode("cells"))
    members = settle(members, "vector-cells")
    sizes = members.groupBy("cell").agg(F.ceil(F.count("vec_id") / SHARD_ROWS).cast("int").alias("shards"))
    # At most MOST_CLUSTERS rows.
    members = members.join(F.broadcast(sizes), "cell").withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("shards")).cast("int"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _streamed(batches, 2):
            rows = list(group)
            ids = np.array([r[2] for r in rows])
            lists = [ids[k[k >= 0]].tolist() for k in robust_prune(_vectors(rows, 3))]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(lists, pa.list_(pa.int64()))], ["vec_id", "near"])

    shards = members.select("cell", "shard", "vec_id", "v").repartition("cell", "shard").sortWithinPartitions("cell", "shard", "vec_id")
    graph = shards.mapInArrow(build, "vec_id long, near array<long>")
    graph = settle(graph.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "vector-graph")
    nodes = members.join(graph, "vec_id")
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other")
    spread = nodes.select("cell", "shard", "vec_id", "cells", "v", "near", every)
    # Block b of a cluster's vectors asks shard s; a row where both are its own serves both ends.
    asks = spread.select("cell", F.col("other").alias("s"), F.col("shard").alias("b"), "vec_id", "cells", "v", "near", (F.col("other") == F.col("shard")).alias("held"), F.lit(True).alias("asks"))
    held = spread.filter("other <> shard").select("cell", F.col("shard").alias("s"), F.col("other").alias("b"), "vec_id", "cells", "v", "near", F.lit(True).alias("held"), F.lit(False).alias("asks"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (cell, *_), group in _streamed(batches, 3):
            rows = list(group)
            index, asking = [r for r in rows if r[7]], [r for r in rows if r[8]]
            if not index or not asking:
                continue
            place = {r[3]: k for k, r in enumerate(index)}
            lists = np.full((len(index), max(1, max(len(r[6]) for r in index))), -1)
            for k, r in enumerate(index):
                own = [place[j] for j in r[6] if j in place]
                lists[k, : len(own)] = own
            hit = range_search(_vectors(asking, 5), _vectors(index, 5), lists, threshold, beam)
            a, b = np.nonzero(hit)
            ids_a, ids_b = np.array([r[3] for r in asking]), np.array([r[3] for r in index])
            cells_a, cells_b = np.array([r[4] for r in asking]), np.array([r[4] for r in index])
            keep = ids_a[a] != ids_b[b]
            a, b = a[keep], b[keep]
            same = (cells_a[a][:, :, None] == cells_b[b][:, None, :]).any(2)
            first = np.where(same, cells_a[a], np.iinfo(np.int32).max).min(1) == cell
            n_links = np.bincount(a[first], minlength=len(asking))
            out = [(0, int(i), int(k)) for i, k in zip(ids_a, n_links) if k]
            names = {i: k for k, i in enumerate(dict.fromkeys([*ids_a.tolist(), *ids_b.tolist()]))}
            forest = Forest(len(names))
            for i, j in zip(ids_a[a].tolist(), ids_b[b].tolist()):
                if forest.join(names[i], names[j]):
                    out.append((1, i, j))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64()))], ["kind", "a", "b"])

    dealt = asks.union(held).repartition("cell", "s", "b").sortWithinPartitions("cell", "s", "b", "vec_id")
    return settle(dealt.mapInArrow(search, "kind int, a long, b long"), "vector-links")


def true_links(usable: DataFrame, ids: list[int], threshold: float = THRESHOLD) -> dict[int, int]:
    """Links of a few vectors against all, by brute force; the vectors asked for travel to all tasks."""
    rows = sorted((r["vec_id"], r["v"]) for r in usable.filter(F.col("vec_id").isin(ids)).collect())
    if not rows:
        return {}
    asked, x = np.array([r[0] for r in rows]), _unit(np.array([r[1] for r in rows]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(asked), np.int64)
        for batch in batches:
            if batch.num_rows:
                ids_, v = batch.column(0).to_numpy(), _unit(np.array(batch.column(1).to_pylist(), np.float64))
                total += ((x @ v.T >= threshold) & (asked[:, None] != ids_[None, :])).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(asked), pa.array(total)], ["vec_id", "n"])

    got = usable.mapInArrow(count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n")).collect()
    return {r["vec_id"]: r["n"] for r in got}


def audit(usable: DataFrame, threshold: float = THRESHOLD) -> dict[int, int]:
    """True links of some vectors that have any.

    Vectors are drawn in hash order, more of them while fewer than ``AUDIT_LINKED`` are linked, ``MOST_AUDITED`` at most.
    """
    drawn, many = {}, AUDITED
    while True:
        ids = [r["vec_id"] for r in usable.orderBy(F.xxhash64("vec_id", F.lit(2)), "vec_id").limit(many).select("vec_id").collect()]
        drawn |= true_links(usable, [i for i in ids if i not in drawn], threshold)
        linked = {i: n for i, n in drawn.items() if n}
        if len(linked) >= AUDIT_LINKED or len(ids) < many or many >= MOST_AUDITED:
            return linked
        many = min(4 * many, MOST_AUDITED)


def _groups_of(usable: DataFrame, n: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(vec_id, n_links) and edges of the vectors of one length.

    The search is widened until the audited vectors have ``LEAST_RECALL`` of their links, as a mean over vectors, so that
    one large group cannot hide lost pairs. Without a linked vector to audit, nothing can be measured and the widest search
    is taken. A search that is still below ``CONTRACT_RECALL`` at the end is an error.
    """
    truth = audit(usable, threshold)
    asked = usable.sparkSession.createDataFrame([(i,) for i in truth] or [(0,)], "vec_id long")
    widths = ((OVERLAP, BEAM), (OVERLAP + 1, 3 * BEAM), (OVERLAP + 3, 8 * BEAM))
    recall = 1.0
    for overlap, beam in widths if truth else widths[-1:]:
        links = _links(usable, n, threshold, overlap, beam)
        found = links.filter("kind = 0").groupBy(F.col("a").alias("vec_id")).agg(F.sum("b").alias("n_links"))
        if truth:
            got = {r["vec_id"]: r["n_links"] for r in found.join(F.broadcast(asked), "vec_id").collect()}
            recall = float(np.mean([min(1.0, got.get(i, 0) / k) for i, k in truth.items()]))
            if recall >= LEAST_RECALL:
                break
    if recall < CONTRACT_RECALL:
        raise RuntimeError(f"the widest search finds {recall:.3f} of the links, as a mean over {len(truth)} audited vectors")
    return found, links.filter("kind = 1").select("a", "b")


def embedding_groups(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector. Vectors of each length are a graph of their own."""
    vectors = settle(clean_vectors(df, id_col, vector_col), "vectors")
    usable = vectors.filter("v IS NOT NULL").withColumn("width", F.size("v"))
    widths = {r["width"]: r["n"] for r in usable.groupBy("width").agg(F.count("*").alias("n")).collect()}
    found = df.sparkSession.createDataFrame([], "vec_id long, n_links long")
    edges = df.sparkSession.createDataFrame([], "a long, b long")
    for width, n in sorted(widths.items()):  # one, in a table of one model's vectors
        own, linked = _groups_of(usable.filter(F.col("width") == width).drop("width"), n, threshold)
        found, edges = found.union(own), edges.union(linked)
    groups = components(edges).withColumnRenamed("node", "vec_id")
    out = vectors.select("vec_id").join(found, "vec_id", "left").join(groups, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
