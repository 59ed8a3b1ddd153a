"""Order-preserving blocks of integers, by which a key of any size is cut."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_BITS = 20


def value_block(value: Column | str, bits: int = BLOCK_BITS) -> Column:
    """At most ``2**bits`` distinct values each; all values of a block are below those of the next."""
    column = F.col(value) if isinstance(value, str) else value
    return F.shiftright(column.cast("bigint"), bits)
