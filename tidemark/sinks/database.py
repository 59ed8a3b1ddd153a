"""Appending to a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tidemark.functions.text import bind_types
from tidemark.sources.tables import split_table_name


def target_table(database: str, source_name: str) -> str:
    """Third part of the source's name, in the target database."""
    return f"{database}.{split_table_name(source_name)[2]}"


def append_to_database(
    df: DataFrame,
    source_name: str,
    database: str,
    url: str,
    properties: Mapping[str, str],
    connections: int = 16,
    rows_per_insert: int = 1000,
) -> None:
    """Append all columns of ``df``; values are bound by type, NULL stays NULL.

    Rows go from the executors in batched inserts over at most ``connections`` connections.
    """
    bind_types(df).write.option("numPartitions", connections).option("batchsize", rows_per_insert).jdbc(
        url, target_table(database, source_name), mode="append", properties=dict(properties)
    )
