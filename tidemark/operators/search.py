"""The first row beyond a place whose value is within a bound, for groups of any size.

A window can't answer it, as every query has a bound of its own. The rows of a key, numbered in order, are the leaves of a tree: a node tells
the least value below each of its ``FAN`` children. A query climbs from its place until a node has a later child within the bound and goes
down from there to the first row. A step is one join of queries and nodes, so that the work is queries times depth, the logarithm to
base ``FAN`` of the largest key, and no task holds a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ranges
from tidemark.session import scratch_path

FAN = 256


def _nodes(rows: DataFrame, keys: Sequence[str], child: str, least: str, place: str | None) -> DataFrame:
    """The nodes over some children, with at most ``FAN`` of them each."""
    one = [F.col(child).alias("child"), F.col(least).alias("least"), *([F.col(place).alias("place")] if place else [])]
    return rows.groupBy(*keys, F.floor(F.col(child) / FAN).alias("node")).agg(
        F.array_sort(F.collect_list(F.struct(*one))).alias("children"), F.min(least).alias("least")
    )


def _step(queries: DataFrame, nodes: DataFrame, keys: Sequence[str], node: Column, later: bool) -> DataFrame:
    """The queries with ``hit``, the node's first child within the bound, only from ``_from`` on if ``later``."""
    prefixed = nodes.select(*[F.col(key).alias(f"_node_{key}") for key in keys], F.col("node").alias("_node"), "children")
    joined = queries.withColumn("_at_node", node).join(prefixed, ranges.same(keys, "_node_") & (F.col("_at_node") == F.col("_node")))

    def fits(child: Column) -> Column:
        within = child["least"] <= F.col("bound")
        return within & (child["child"] >= F.col("_from")) if later else within

    return joined.withColumn("hit", F.get(F.filter("children", fits), F.lit(0))).drop(*prefixed.columns, "_at_node")


def first_within(rows: DataFrame, queries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``queries(keys, at, bound)`` with ``place``, that of the first of ``rows(keys, number, place, value)`` numbered above ``at`` with a value of at most ``bound``.

    The rows of a key are numbered 0, 1, 2, …; one without value is never found. A query without such a row is left out, and so are those
    without place or bound; null keys are equal. Other columns of the queries stay, but for names that begin with an underscore, ``hit`` and ``place``.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "search-nodes")
    _nodes(rows, keys, "number", "value", "place").write.parquet(path)
    levels = [spark.read.parquet(path)]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    while top:
        levels.append(_nodes(levels[-1], keys, "node", "least", None))
        top //= FAN
    climbing = queries.filter("at is not null and bound is not null").withColumn("_from", F.greatest(F.col("at") + 1, F.lit(0)))
    found = []
    for nodes in levels:
        # A place without a node lies beyond the key's last row, so that nothing is lost by the join.
        node = F.floor(F.col("_from") / FAN)
        seen = _step(climbing, nodes, keys, node, later=True)
        found.append(seen.filter("hit is not null"))
        climbing = seen.filter("hit is null").drop("hit").withColumn("_from", node + 1)
    falling = None
    for nodes, here in zip(reversed(levels[:-1]), reversed(found[1:]), strict=True):
        above = here if falling is None else falling.unionByName(here)
        # A node's child has the number of the node below it.
        falling = _step(above.withColumn("_down", F.col("hit.child")).drop("hit"), nodes, keys, F.col("_down"), later=False).drop("_down")
    hits = found[0] if falling is None else found[0].unionByName(falling)
    return hits.withColumn("place", F.col("hit.place")).drop("hit", "_from")
