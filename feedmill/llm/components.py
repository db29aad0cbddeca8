"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_dir, split_join


def _stars(edges: DataFrame) -> DataFrame:
    """One round: every node moves to the least neighbour of its parents, then siblings meet at the least parent."""
    both = edges.select(F.col("lo").alias("lo"), F.col("hi").alias("other")).union(edges.select(F.col("hi"), F.col("lo")))
    least = both.groupBy("lo").agg(F.least(F.min("other"), F.col("lo")).alias("m"))
    large = split_join(edges, least, ["lo"], "inner").select(F.col("m").alias("lo"), "hi").distinct()
    root = large.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = split_join(large, root, ["hi"], "inner").filter(F.col("lo") != F.col("m")).select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return moved.union(root.select(F.col("m").alias("lo"), "hi")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the edges' two long columns; component is the least node reachable.

    Each round is checkpointed in the shared folder; a round's state is one row per edge, and only its row count and a
    hash sum reach the driver. Edges with a null end are ignored; the result is empty for an empty table.
    """
    shared_dir(edges.sparkSession)
    a, b = (F.col(c).cast("long") for c in edges.columns[:2])
    edges = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), a.isNotNull().alias("x"), b.isNotNull().alias("y"))
    edges = edges.filter("x AND y AND lo < hi").select("lo", "hi").distinct().checkpoint()

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("lo"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())

    before = mark(edges)
    while before[0]:
        edges = _stars(edges).checkpoint()
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        edges.select(F.col("lo"), F.col("lo")).distinct()
    )


class Forest:
    """Union-find over positions, for the few thousand rows that one task holds at a time."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether x and y were apart; they are not any more."""
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y
