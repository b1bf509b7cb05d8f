"""Connected components of an edge table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanstar.llm.rows import as_batch
from gleanstar.session import stage

_EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])
EDGES_DDL = "a binary, b binary"


class UnionFind:
    """Disjoint sets with path halving; the smallest member names a set."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        parent = self.parent
        if x not in parent:
            parent[x] = x
            return x
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self):
        """One edge for each member that does not name its set."""
        return [(x, root) for x in list(self.parent) if (root := self.find(x)) != x]


def edge_batch(edges) -> pa.RecordBatch:
    return as_batch(_EDGES, *zip(*edges, strict=True))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its
    smallest node. Smallest labels move along edges and then along labels, so chains shorten
    by more than half a round; every round is stored in the shared folder."""
    # Tasks name the same sets by different members. Each node keeps its edge to its smallest
    # neighbour and its other neighbours take it over: these edges repeat and fall together.
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.withColumn("least", F.min("b").over(Window.partitionBy("a")))
    star = least.select("a", F.col("least").alias("b")).union(least.select(F.col("b").alias("a"), F.col("least").alias("b")))
    star = stage(star.filter("a <> b").distinct(), "stars")
    both = stage(star.union(star.select("b", "a")).distinct(), "edges")
    label = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        moved = label.join(near, label["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("via"))
        jump = label.select(F.col("node").alias("via"), F.col("label").alias("target"))
        new = moved.join(jump, "via").select("node", "old", F.least("via", "target").alias("label"))
        new = stage(new, "labels")
        if new.filter("old <> label").isEmpty():
            return new.select("node", F.col("label").alias("component"))
        label = new.select("node", "label")
