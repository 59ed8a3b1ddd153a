"""Loading tables that already exist, leaving unnamed columns to their defaults."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

TRUNCATE, APPEND = "truncate", "append"


def require_table(spark: SparkSession, table: str) -> None:
    """Loads never create their target."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")


def load_table(df: DataFrame, table: str, how: str = APPEND, partition: Mapping[str, int] | None = None) -> None:
    """Write the rows into ``table``, or into the one ``partition`` of it, replacing the content or adding to it.

    Columns the frame does not have get the table's DEFAULT, or NULL without one; a column the table does
    not have is an error. The insert is SQL because only SQL inserts fill defaults.
    """
    spark = df.sparkSession
    require_table(spark, table)
    if how not in (TRUNCATE, APPEND):
        raise ValueError(f"unknown load {how}")
    view = f"load_{uuid.uuid4().hex}"
    names = ", ".join(f"`{name}`" for name in df.columns)
    verb = "OVERWRITE" if how == TRUNCATE else "INTO"
    where = f"PARTITION ({', '.join(f'`{name}` = {int(value)}' for name, value in partition.items())})" if partition else ""
    df.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT {verb} {table} {where} ({names}) SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
