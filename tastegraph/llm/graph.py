"""Connected components: union-find within tasks, star contraction between."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import materialize


class UnionFind:
    """Disjoint sets whose root is their least member."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while (up := self.parent.get(x, x)) != root:
            self.parent[x], x = root, up
        return root

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


#: Links that one task joins at a time, some 100 MB.
BLOCK = 500_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def roots(sets: UnionFind) -> pd.DataFrame:
        return pd.DataFrame([(x, sets.find(x)) for x in list(sets.parent)], columns=["u", "v"], dtype="int64")

    sets = UnionFind()
    for b in batches:
        for u, v in zip(b["u"].tolist(), b["v"].tolist()):
            sets.union(u, v)
        if len(sets.parent) > BLOCK:
            yield roots(sets)
            sets = UnionFind()
    yield roots(sets)


def components(edges: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, root) for every end of the undirected ``edges`` (u, v: long);
    root is the least node of the component.

    Each task first replaces its links by a union-find forest.  If the
    forests count no more than ``BLOCK`` links, one more union-find ends it.
    Else rounds of star contraction hang every node's larger neighbours, and
    then its smaller ones, on its least neighbour until nothing changes: a
    number of rounds that grows with the logarithm of the longest path.  A
    node's least neighbour is a partial aggregate, so a node with many links
    is no hot task.
    """
    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def forests(links: DataFrame) -> DataFrame:
        return materialize(links.mapInPandas(_forest, "u long, v long"), "links")  # u > v

    edges = forests(edges.select("u", "v").filter("u <> v"))
    state, small = None, edges.count() <= block
    if small:
        edges = forests(edges.coalesce(1))
    while not small:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        rehung = large.join(least(large), "u")
        hung = (rehung.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(rehung.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(hung, "links")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")).first()
        if state == now:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
