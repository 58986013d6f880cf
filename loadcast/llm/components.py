"""Connected components of an edge table, distributed (large-star, small-star).

Nodes are longs.  No step gathers a neighbourhood into one row: each star is a
minimum (partially aggregated) joined back to the edges, so a hub that holds a
third of all edges is an ordinary skewed join, which AQE splits.  Each round is
written to the shared folder and replaces the one before; rounds grow with the logarithm of the diameter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import discard, stored


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    large = (both.filter("v > u").join(low, F.col("u") == F.col("k"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())  # u > v
    low2 = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
    small = (large.join(low2, F.col("u") == F.col("k"))
             .select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b")))
    return small.filter("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` -> ``(node, component)`` for every node but the
    smallest of its component; ``component`` is that smallest node.  Self
    loops, repeated edges and an empty table are fine."""
    edges, path = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct(), "cc")
    mark = _mark(edges)
    while mark[0]:
        edges, now = stored(_round(edges), "cc")
        discard(edges.sparkSession, path)  # the next round is whole
        path, new = now, _mark(edges)
        if new == mark:
            break
        mark = new
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


class Forest:
    """Union-find over ``0..n-1`` for use inside one bounded task: pairs go in
    chunk by chunk, a spanning forest (at most n - 1 links) comes out."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        p = self.parent
        while len(a):
            ra, rb = p[a], p[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(p, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(q := p[p], p):
                p[:] = q

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        i = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return i, self.parent[i]
