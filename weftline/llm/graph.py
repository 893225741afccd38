"""Connected components over an edge table of any size: union-find within partitions, then alternating stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import discard, written


class Forest:
    """Union-find over dense numbers; the smaller root wins."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if a < b:
            a, b = b, a
        self.up[a] = b
        return True


#: Edges that a task holds at once.
HELD = 1 << 20


def _stars(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Edges to stars around the smallest node of each of their components."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    forest = Forest(len(nodes))
    for a, b in zip(at[: len(u)].tolist(), at[len(u) :].tolist(), strict=True):
        forest.union(a, b)
    root = np.array([forest.find(k) for k in range(len(nodes))], np.int64)
    keep = root != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[keep], pa.int64()), pa.array(nodes[root[keep]], pa.int64())], names=["u", "v"])


def _squeeze(batches):
    """Edges of a partition to stars, HELD of them at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for b in batches:
        held.append((b.column("u").to_numpy(zero_copy_only=False), b.column("v").to_numpy(zero_copy_only=False)))
        size += b.num_rows
        if size >= HELD:
            yield _stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield _stars(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _is_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge down or edges up, never both: then every component is a star and none can change."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where((F.col("down") > 1) | (F.col("down") + F.col("up") > 1)).isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(u, v) -> node, component (the smallest node that it reaches), a row for each node with an edge to another.

    Large stars and small stars in turn (Kiveris and others, 2014) take about log(n) rounds, until all components are
    stars; every round is a written table. A hub's minimum is aggregated before the shuffle and written by itself, so
    that nothing but a plain join reads the hub's edges, which Spark splits over tasks (skewed join). Up to HELD edges
    need no rounds: one task holds them all. Nulls and loops are no edges; an edge given twice counts once; no edges
    give no rows. The last table written is what the result is read from.
    """
    edges = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    edges = written(edges.mapInArrow(_squeeze, "u long, v long").distinct(), name, slim=True)
    if edges.count() <= HELD:
        before, edges = edges, written(edges.coalesce(1).mapInArrow(_squeeze, "u long, v long"), name, slim=True)
        discard(before)
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name, slim=True)
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), name, slim=True)
        lowest = written(large.groupBy("u").agg(F.min("v").alias("m")), name, slim=True)
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, written(small.unionByName(lowest.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), name, slim=True)
        discard(before, least, large, lowest)
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("node"), "component").distinct())
