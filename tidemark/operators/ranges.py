"""Running aggregates over groups of any size, cut by number of rows.

A plain window over a key sorts the whole key in one task. Here all rows are dealt out in one order of key and place, by ranges
that Spark sizes from a sample of the rows themselves: bursts, ties and hot keys spread like all other rows. The
window runs inside a range, and what a key has gathered in earlier ranges is added. Only the first key of a
range can have begun earlier, so there is at most one such row per range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

RANGE = "_range"


def same(keys: Sequence[str], prefix: str) -> Column:
    """The keys equal their prefixed counterparts; nulls are equal."""
    return reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(prefix + key)) for key in keys], F.lit(True))


def dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None) -> DataFrame:
    """The rows with the number of their range, written so that every reader sees the same ranges.

    There are ``parts`` ranges, by default as many as the session has shuffle partitions, for tables of any size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *[F.col(name) for name in [*keys, *order]])
    ordered.withColumn(RANGE, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def _stored(df: DataFrame) -> DataFrame:
    """The rows written as they are."""
    path = scratch_path(df.sparkSession, "ranges")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    own: bool = True,
    backward: bool = False,
    keep: bool = False,
) -> DataFrame:
    """Add sums and maxima over the rows of the same key before the row, or after it if ``backward``, and with ``own`` over the row itself.

    With ``keep`` the rows keep their range. Rows that have one are not dealt again: the ranges they were given must be in order of these keys and places, too.
    ``order`` should tell all rows of a key apart; rows that it doesn't are taken in any order. Null keys are a key like
    any other, and null places come first.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    placed = _stored(df) if RANGE in df.columns else dealt(df, keys, order)
    turned = F.desc if backward else F.asc
    measures = [F.sum(column).alias(name) for name, column in sums.items()]
    measures += [F.max(column).alias(name) for name, column in maxima.items()]
    summary = placed.groupBy(*keys, RANGE).agg(*measures)
    before = Window.partitionBy(*keys).orderBy(turned(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary.withColumns(
            {name: F.sum(name).over(before) for name in sums} | {name: F.max(name).over(before) for name in maxima}
        )
        .withColumn("_earlier", F.count(F.lit(1)).over(before))
        .filter("_earlier > 0")
        .drop("_earlier")
    )
    carried = carried.select(*[F.col(name).alias(f"_before_{name}") for name in carried.columns])
    inside = Window.partitionBy(*keys, RANGE).orderBy(*[turned(name) for name in order]).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    local = {name: F.sum(column).over(inside) for name, column in sums.items()}
    local |= {name: F.max(column).over(inside) for name, column in maxima.items()}
    # At most one row per range, hence the broadcast.
    joined = placed.withColumns(local).join(F.broadcast(carried), same([*keys, RANGE], "_before_"), "left")
    complete = {name: F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"_before_{name}"), F.lit(0)) for name in sums}
    complete |= {name: F.greatest(name, f"_before_{name}") for name in maxima}
    return joined.withColumns(complete).drop(*([] if keep else [RANGE]), *carried.columns)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of every key 0, 1, 2, … in ``order``."""
    counted = running(df, keys, order, {name: F.lit(1).cast("bigint")})
    return counted.withColumn(name, F.col(name) - 1)
