"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import written


def local_roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of ``count`` numbers, linked by the pairs ``a``, ``b``."""
    root = np.arange(count)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        np.minimum.at(root, high[open_], low[open_])
        while (root != root[root]).any():
            root = root[root]
    return root


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    ways = _both_ways(links)
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return ways.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them; links point from ``a`` down to ``b``."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of all linked nodes but the roots, from pairs ``a``, ``b``.

    Every round is written to the shared folder; a star's centre may have any number of neighbours, as its minimum is
    combined before the shuffle and the joins are ones that adaptive execution may split. Pairs of a node with itself
    or with nulls do not count. The rounds end when the links are stars and no longer change.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = written(pairs, "links")
    before = _state(current)
    while before[0]:
        current = written(_small_star(_large_star(current)), "links")
        now = _state(current)
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
