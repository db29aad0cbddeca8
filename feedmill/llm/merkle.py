"""Merkle manifest of a table: one hash tree a group, one tree over the groups' roots, and a proof for every row.

Time-forward processing: nodes are labelled by (last leaf below them, level), so that children come before their parents.
The external priority queue has two layers. Between tasks it is Spark's sorted shuffle: the nodes of a level are dealt to
stretches of ``arity ** levels`` neighbours and arrive in label order, spilled to disk where memory ends. Within a stretch
a heap holds the digests on their way to a parent, never more than a few a level. Each sweep settles the roots of its
stretches, which are the nodes of the next sweep, until every tree has one node left. The reversed sweeps go down again:
each stretch gets its root's proof suffix as a message that sorts before its nodes, computes its digests anew, and
a heap in reversed label order delivers suffixes to the children, down to the leaves.

Cases: null fields enter a leaf as ``-``, so they differ from empty texts; a null group is a group of its own, before all
others; a null id sorts before all others; rows with equal ids sort by their leaf, and equal rows are leaves that stand
several times. A tree of one leaf is that leaf. Very long texts are hashed whole. An empty table gives no rows.
Columns of other names are not read, and the operator's own are held in a struct, so that no names clash.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import grouped, settle

ARITY = 2
#: Levels that one sweep computes; a stretch has ARITY ** LEVELS nodes at most.
LEVELS = 12
PROOF = "array<struct<left: string, right: string>>"
_NODE = "tree string, idx long, n long, digest string"


def digest_of(*fields: Column | str) -> Column:
    """SHA-256 of a row: each field as ``-`` where null, else its UTF-8 length, a colon and its value."""
    parts = []
    for field in fields:
        value = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _depth(n: int, arity: int, levels: int) -> int:
    """Levels above ``n`` nodes of a tree that this sweep computes: all that are left, or a stretch's."""
    depth = 0
    while n > 1 and depth < levels:
        n, depth = -(-n // arity), depth + 1
    return depth


def forward(digests: list[str], depth: int, arity: int = ARITY) -> Iterator[tuple[int, int, list[str]]]:
    """The inner nodes of a stretch in label order: (level, place, digests of the children). The root is the last."""
    queue: list[tuple[int, int, int, str]] = []  # label of the receiver (last leaf, level), the child's place, its digest
    many = len(digests)

    def send(level: int, place: int, digest: str) -> None:
        if level <= depth:
            last = min((place // arity + 1) * arity**level, many) - 1
            heapq.heappush(queue, (last, level, place, digest))

    for leaf, digest in enumerate(digests):
        send(1, leaf, digest)
        while queue and queue[0][0] == leaf:
            level, children = queue[0][1], []
            while queue and queue[0][:2] == (leaf, level):
                _, _, place, child = heapq.heappop(queue)
                children.append(child)
            place //= arity
            yield level, place, children
            send(level + 1, place, _hash(children))


def backward(digests: list[str], depth: int, suffix, arity: int = ARITY) -> list:
    """The leaves' proofs as linked pairs ((left, right), rest), from the root's suffix."""
    below = {(level, place): children for level, place, children in forward(digests, depth, arity)}
    many, out = len(digests), [None] * len(digests)
    queue = [(1 - many, -depth, 0, suffix)]
    while queue:
        _, level, place, rest = heapq.heappop(queue)
        if not level:
            out[place] = rest
            continue
        children = below[-level, place]
        for k in range(len(children)):
            child, level_ = place * arity + k, -level - 1
            siblings = ("".join(children[:k]), "".join(children[k + 1 :]))
            last = min((child + 1) * arity**level_, many) - 1
            heapq.heappush(queue, (-last, -level_, child, (siblings, rest)))
    return out


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """(tree, idx, n, digest, row): places within each tree, and the tree's size. The order's columns are within row.

    Rows are dealt by range of the whole order, equal ones by an extra number, so that no tree and no id is one task's.
    A row's number in its task less the tree's first one there, plus the tree's rows in the tasks before, is its place.
    """
    keys = ["tree", *order, "digest", "_more"]
    dealt = nodes.withColumn("_more", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = settle(dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("_at", 33)).select("tree", "digest", "row", "part", "_at"), "merkle-order")
    counts = dealt.groupBy("tree", "part").agg(F.min("_at").alias("first"), F.count("*").alias("here"))
    counts = settle(counts, "merkle-counts")
    sizes = counts.groupBy("tree").agg(F.sum("here").alias("n"))
    # A row for each part of the shuffle and tree.
    before = F.sum("here").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0))).join(sizes, "tree")
    placed = dealt.join(counts.drop("here"), ["tree", "part"])
    return placed.select("tree", (F.col("_at") - F.col("first") + F.col("before")).alias("idx"), "n", "digest", "row")


def _queued(nodes: DataFrame, width: int, *first: str) -> DataFrame:
    """The external queue: stretches of a level in tasks of their own, in label order."""
    df = nodes.withColumn("stretch", F.expr(f"idx div {width}"))
    return df.repartition("tree", "stretch").sortWithinPartitions("tree", "stretch", *first, "idx")


def _swept_up(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """The nodes of every sweep, from the leaves to one node a tree."""
    tables, width = [nodes], arity**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, stretch), part in grouped(batches, ["tree", "stretch"]):
            n, digests = part["n"][0].as_py(), part["digest"].to_pylist()
            root = digests[0]
            for _, _, children in forward(digests, _depth(n, arity, levels), arity):
                root = _hash(children)
            row = {"tree": [tree], "idx": [stretch], "n": [-(-n // width)], "digest": [root]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]))

    while True:
        some = tables[-1].select("tree", "idx", "n", "digest")
        tables.append(settle(_queued(some, width).mapInArrow(run, _NODE), "merkle-nodes"))
        if (tables[-1].agg(F.max("n")).first()[0] or 1) == 1:
            return tables


def _swept_down(tables: list[DataFrame], messages: DataFrame, arity: int, levels: int) -> DataFrame:
    """(tree, idx, row, proof, top): the leaves with their proofs; ``messages`` (tree, idx, proof, top) are for the trees' roots."""
    width = arity**levels
    pair = pa.struct([("left", pa.string()), ("right", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, _), part in grouped(batches, ["tree", "stretch"]):
            rest = None
            for level in reversed(part["proof"][0].as_py()):
                rest = ((level["left"], level["right"]), rest)
            top, part = part["top"][0].as_py(), part.slice(1)
            proofs = backward(part["digest"].to_pylist(), _depth(part["n"][0].as_py(), arity, levels), rest, arity)
            left, right, ends = [], [], [0]
            for proof in proofs:
                while proof is not None:
                    (a, b), proof = proof
                    left.append(a)
                    right.append(b)
                ends.append(len(left))
            pairs = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], fields=list(pair))
            columns = [pa.array([tree] * len(part), pa.string()), part["idx"].combine_chunks(), part["digest"].combine_chunks(), part["row"].combine_chunks(), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs), pa.array([top] * len(part), pa.string())]
            yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], ["tree", "idx", "digest", "row", "proof", "top"])

    for nodes in reversed(tables[:-1]):
        row = nodes.schema["row"].dataType.simpleString() if "row" in nodes.columns else "int"
        if "row" not in nodes.columns:
            nodes = nodes.withColumn("row", F.lit(None).cast("int"))
        nodes = nodes.select("tree", "idx", "n", "digest", "row", F.lit(None).cast(PROOF).alias("proof"), F.lit(None).cast("string").alias("top"), F.lit(1).alias("kind"))
        # A message goes to the stretch of its number.
        sent = messages.select("tree", (F.col("idx") * width).alias("idx"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast(row).alias("row"), "proof", "top", F.lit(0).alias("kind"))
        queue = _queued(nodes.unionByName(sent), width, "kind")
        messages = queue.mapInArrow(run, f"tree string, idx long, digest string, row {row}, proof {PROOF}, top string")
    return messages


def merkle_manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    carry: dict[str, Column] | None = None,
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """The order column, what ``carry`` names, leaf, subroot, root and proof of every row.

    proof lists, from the leaf to the root, what its run's other nodes add before and after it.
    """
    named = {order: F.col(order)} | (carry or {})
    row = F.struct(*[c.alias(name) for name, c in named.items()])
    # Null first, then by bytes: the order of the trees too.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = settle(docs.select(tree.alias("tree"), F.col(order).alias("_order"), digest_of(*fields).alias("digest"), row.alias("row")), "merkle-leaves")
    trees = _swept_up(settle(_numbered(leaves, ["_order"]), "merkle-placed"), arity, levels)
    tops = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("_order"), "digest", F.struct("tree").alias("row"))
    above = _swept_up(settle(_numbered(tops, ["_order"]), "merkle-tops"), arity, levels)
    found = above[-1].first()
    root = F.lit(found["digest"] if found else None).cast("string")
    start = above[-1].select("tree", "idx", F.lit(None).cast("string").alias("top"), F.expr(f"cast(array() AS {PROOF})").alias("proof"))
    suffixes = settle(_swept_down(above, start, arity, levels).select(F.col("row.tree").alias("tree"), F.lit(0).cast("long").alias("idx"), "proof", F.col("digest").alias("top")), "merkle-suffixes")
    done = _swept_down(trees, suffixes, arity, levels)
    return done.select(*[F.col("row").getField(name).alias(name) for name in named], F.col("digest").alias("leaf"), F.col("top").alias("subroot"), root.alias("root"), "proof")


def folded(leaf: str, proof: str = "proof") -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, F.col(leaf), lambda a, p: F.sha2(F.concat(p["left"], a, p["right"]).cast("binary"), 256))


def proof_digest(proof: str = "proof") -> Column:
    """SHA-256 of all siblings, from the leaf upwards."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "").cast("binary"), 256)
