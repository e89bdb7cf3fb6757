"""Connected components, within a task and of a whole table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import Written


class Forest:
    """Union-find over 0..n-1 for whole arrays of links; a root is its set's smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        found = self.parent[x]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                self.parent[x] = found
                return found
            found = above

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def components(edges: DataFrame, held: Written) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node but the smallest ones.

    ``edges`` has the columns ``a`` and ``b``. Rounds of two steps bend links towards smaller
    nodes: first each node hands its larger neighbours the smallest one around it, then its
    smaller ones. Both keep what is connected, links never grow in number, and what remains is a
    star around each smallest node. A round costs four written tables, so every join reads both
    sides from storage and a node with very many links can be split among tasks.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = held.table(
        edges.where("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct()
    )
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = held.table(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
        large = held.table(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        least_below = held.table(large.groupBy("a").agg(F.min("b").alias("m")))
        joined = large.join(least_below, "a")
        small = held.table(
            joined.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
            .where("a <> b")
            .unionByName(least_below.select("a", F.col("m").alias("b")))
            .distinct()
        )
        now = small.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        held.drop(edges, least, large, least_below)
        edges = small
        if (now.n, now.h) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = (now.n, now.h)
