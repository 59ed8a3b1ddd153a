"""Grouping keyed rows into batches of limited size, and the launch manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranges import number_rows

BATCH_SIZE = 25


def number_batches(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int = BATCH_SIZE) -> DataFrame:
    """Add ``batch_no``: consecutive runs of ``size`` rows per key, in ``order``; a key may be of any size."""
    return (
        number_rows(df, keys, order, "_position")
        .withColumn("batch_no", F.floor(F.col("_position") / F.lit(size)).cast("bigint"))
        .drop("_position")
    )


def collect_batches(numbered: DataFrame, keys: Sequence[str], order: str, element: str) -> DataFrame:
    """One row per batch: ``items`` (ordered elements, at most the batch size) and ``size``."""
    pair = F.struct(F.col(order).alias("at"), F.col(element).alias("element"))
    return numbered.groupBy(*keys, "batch_no").agg(F.sort_array(F.collect_list(pair)).alias("_pairs")).select(
        *keys, "batch_no", F.size("_pairs").cast("bigint").alias("size"), F.col("_pairs.element").alias("items")
    )


def export_manifest(batches: DataFrame, keys: Sequence[str], parameters: Mapping[str, str], run: str) -> DataFrame:
    """One launch row per batch: a job name that names the ``run``, the comma-joined tables and the fixed parameters."""
    settings = [part for name, value in parameters.items() for part in (F.lit(name), F.lit(value))]
    names = [F.col(key).cast("string") for key in keys]
    return batches.select(
        F.concat_ws("-", F.lit("export"), F.lit(run), *names, F.col("batch_no").cast("string")).alias("job_name"),
        F.concat_ws(",", "items").alias("tables"),
        (F.create_map(*settings) if settings else F.create_map()).alias("parameters"),
    )
