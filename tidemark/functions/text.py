"""Column functions of the message, table-name and CSV code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MILLIS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def file_path(bucket: Column, name: Column, scheme: str = "gs://") -> Column:
    """``scheme + bucket + "/" + name``; NULL if either part is."""
    return F.concat(F.lit(scheme), bucket, F.lit("/"), name)


def table_name_part(name: Column, part: int) -> Column:
    """Part 1 (project), 2 (dataset) or 3 (table) of a dotted name."""
    return F.split_part(name, F.lit("."), F.lit(part))


def to_long(text: Column) -> Column:
    """Text as long, NULL where it is none."""
    return text.try_cast("bigint")


def millis_text(ts: Column) -> Column:
    return F.date_format(ts, MILLIS_FORMAT)


def row_json(columns: Sequence[str], keep_nulls: bool = True) -> Column:
    """The named columns as one JSON object."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": str(not keep_nulls).lower()})


_BINDABLE = (T.IntegerType, T.FloatType, T.DoubleType, T.BooleanType)


def bind_types(df: DataFrame) -> DataFrame:
    """Integer, float, double and boolean columns stay; every other column becomes text, NULL stays NULL."""
    return df.select(
        *[
            F.col(field.name) if isinstance(field.dataType, _BINDABLE) else F.col(field.name).cast("string").alias(field.name)
            for field in df.schema.fields
        ]
    )
