"""Periodic loads of a stream into an existing table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.sinks.loads import APPEND, TRUNCATE, load_table, require_table

LOAD_INTERVAL = "1 minute"


def append_loads(stream: DataFrame, table: str, batch_column: str | None = None) -> DataStreamWriter:
    """Append every micro-batch to ``table``; the caller sets trigger and checkpoint.

    A table partitioned by a whole number ``batch_column`` keeps the micro-batch's id there: one repeated after a failure
    replaces what it had loaded. Without it a repeated micro-batch is loaded again.
    """
    require_table(stream.sparkSession, table)
    if batch_column is None:
        return stream.writeStream.foreachBatch(lambda rows, batch: load_table(rows, table, APPEND))
    return stream.writeStream.foreachBatch(lambda rows, batch: load_table(rows, table, TRUNCATE, {batch_column: batch}))


def start_loads(
    stream: DataFrame, table: str, checkpoint: str, interval: str = LOAD_INTERVAL, batch_column: str | None = None
) -> StreamingQuery:
    """Load what has arrived once per interval until the query is stopped."""
    return append_loads(stream, table, batch_column).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()
