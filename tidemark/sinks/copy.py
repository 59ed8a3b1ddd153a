"""Copying selected columns of several tables, one Spark job per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation

from tidemark.operators.routing import tap
from tidemark.sources.tables import columns_of, read_columns


def copy_tables(
    names: Sequence[str],
    lists: Mapping[str, Sequence[str]],
    read: Callable[[str], DataFrame],
    write: Callable[[DataFrame, str], None],
    at_once: int = 4,
) -> dict[str, int]:
    """Copy each table's listed columns from ``read(name)`` to ``write(frame, name)``; rows per table.

    All names are checked before the first job starts. Tables are independent, so their jobs overlap.
    """
    wanted = {name: columns_of(lists, name) for name in names}

    def copy(name: str) -> int:
        seen = Observation()
        write(tap(read_columns(read(name), wanted[name]), seen), name)
        return seen.get["rows"]

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return dict(zip(names, pool.map(copy, names), strict=True))
