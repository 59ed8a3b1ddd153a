"""Table scans with a column list per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def columns_of(lists: Mapping[str, Sequence[str]], table: str) -> list[str]:
    """The columns listed for a table; an unlisted table is an error."""
    if table not in lists:
        raise ValueError(f"no column list for table {table}")
    return list(lists[table])


def split_table_name(name: str) -> tuple[str, str, str]:
    """``project.dataset.table`` as three parts."""
    parts = name.split(".")
    if len(parts) != 3:
        raise ValueError(f"expected project.dataset.table, got {name}")
    return parts[0], parts[1], parts[2]


def read_columns(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the listed columns; the parquet reader loads no others."""
    return source.select(*columns)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The parquet table ``folder/table.parquet`` (one file or a folder of files)."""
    return spark.read.parquet(f"{folder}/{table}.parquet")
