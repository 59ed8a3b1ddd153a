"""Reading the corpus tables and cutting lineage with written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def least_hashed(rows: DataFrame, by: str, limit: int) -> DataFrame:
    """The ``limit`` rows with the smallest 64-bit hashes ``by``, the same in every run.

    Only about twice as many are sorted: hashes are evenly spread, so the rows below a bound are counted first. Else every
    task would send its own ``limit`` rows to the driver.
    """
    count = rows.count()
    if count > 2 * limit:
        below = rows.filter(F.col(by) < F.lit(-(1 << 63) + (1 << 64) * 2 * limit // count))
        if below.count() >= limit:
            rows = below
    return rows.orderBy(by).limit(limit)
