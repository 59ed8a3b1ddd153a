"""Main, trace and error outputs of one frame, and taps."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

MAIN, TRACE, ERROR = "main", "trace", "error"


def route(df: DataFrame, problem: Column) -> DataFrame:
    """Add ``tag`` and ``reason``: error where ``problem`` is not NULL, main elsewhere."""
    return df.withColumn("reason", problem).withColumn(
        "tag", F.when(F.col("reason").isNotNull(), ERROR).otherwise(MAIN)
    )


def output(df: DataFrame, tag: str) -> DataFrame:
    """One of the tagged outputs."""
    return df.filter(F.col("tag") == tag)


def format_with_capture(
    df: DataFrame, formatter: Callable[[Column], Column], source: str, target: str, reason: str
) -> DataFrame:
    """Apply a formatter to the main rows; rows it turns to NULL go to the error output.

    ``formatter`` must be built from functions that give NULL instead of raising (``try_…``).
    """
    formatted = df.withColumn(target, formatter(F.col(source)))
    failed = (F.col("tag") == MAIN) & F.col(target).isNull()
    return formatted.withColumn("reason", F.when(failed, reason).otherwise(F.col("reason"))).withColumn(
        "tag", F.when(failed, ERROR).otherwise(F.col("tag"))
    )


def flatten(*frames: DataFrame) -> DataFrame:
    """Union of all rows, duplicates kept, columns matched by name."""
    return reduce(lambda left, right: left.unionByName(right), frames)


def tap(df: DataFrame, observation: Observation | str, **metrics: Column) -> DataFrame:
    """Pass rows on unchanged while counting them (and any further metrics) on the way."""
    return df.observe(
        observation, F.count(F.lit(1)).alias("rows"), *[column.alias(name) for name, column in metrics.items()]
    )
