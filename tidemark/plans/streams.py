"""Streaming queries: the tables replayed as streams, checked like their batch forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import routing, windows
from tidemark.plans.inputs import numbered_events, table, trades
from tidemark.plans.queries import (
    ELEMENTS,
    WIDTHS,
    Query,
    batch_output,
    group_output,
    loaded_output,
    new_default_table,
    stamped,
    summary_output,
)
from tidemark.streaming.batches import collect_batches, collect_lists
from tidemark.streaming.loads import append_loads
from tidemark.streaming.replay import run_slices, run_to_table, slice_count, time_slices
from tidemark.streaming.summaries import run_counts, sequence_runs
from tidemark.streaming.sequencer import JUMP_TO_ARRIVAL, JUMP_TO_PENDING, sequence_channels

DAY_SECONDS = 86_400
MAX_PENDING = 2
MAX_AGE_DAYS = 360


def _ordered_trades(spark: SparkSession, folder: str) -> list[DataFrame]:
    rows = trades(spark, folder)
    slices = time_slices(rows.withColumn("at", F.col("arrival.at")), "at", slice_count(rows, "channel"))
    return [part.drop("at") for part in slices]


def _closing_row(rows: DataFrame, **values) -> DataFrame:
    """One row two days after the last, which lets the watermark close every window before it."""
    last = rows.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"))
    return last.select(
        *[
            F.col("ts") if field.name == "ts" else F.lit(values.get(field.name)).cast(field.dataType).alias(field.name)
            for field in rows.schema.fields
        ]
    )


def _event_slices(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The events by time, a row that closes their windows, and one that comes too late for its own."""
    rows = numbered_events(spark, folder).select("event_id", "ts", "group_key", "sequence")
    slices = time_slices(rows, "ts", slice_count(rows, "group_key"))
    late = rows.agg(F.min("ts").alias("ts")).select(
        F.lit(-2).cast("bigint").alias("event_id"), "ts", F.lit("late").alias("group_key"), F.lit(0).cast("bigint").alias("sequence")
    )
    return [*slices, _closing_row(rows, event_id=-1, group_key="end", sequence=0), late]


def stream_seq_book(spark: SparkSession, folder: str) -> DataFrame:
    emitted = run_to_table(spark, _ordered_trades(spark, folder), sequence_channels, "seq-book")
    return emitted.select(
        "channel",
        "sequence",
        "trade_date",
        "price",
        "released",
        F.date_format("at", "yyyy-MM-dd").alias("released_at"),
    )


def _overflow(spark: SparkSession, folder: str, rule: str, **limits: int) -> DataFrame:
    emitted = run_to_table(
        spark,
        _ordered_trades(spark, folder),
        lambda stream: sequence_channels(stream, on_overflow=rule, **limits),
        "seq-overflow",
    )
    return emitted.select(
        "channel",
        "kind",
        "sequence",
        "price",
        "released",
        F.date_format("at", "yyyy-MM-dd").alias("at"),
        "skipped_from",
        "skipped_to",
        "pending_last",
        "remaining",
    )


def seq_overflow(spark: SparkSession, folder: str) -> DataFrame:
    return _overflow(spark, folder, JUMP_TO_ARRIVAL, max_pending=MAX_PENDING)


def seq_overflow_pending(spark: SparkSession, folder: str) -> DataFrame:
    return _overflow(spark, folder, JUMP_TO_PENDING, max_pending=MAX_PENDING)


def seq_overflow_age(spark: SparkSession, folder: str) -> DataFrame:
    """The book jumps to the smallest waiting sequence where it has not advanced for long, however few wait."""
    return _overflow(spark, folder, JUMP_TO_PENDING, max_age_seconds=MAX_AGE_DAYS * DAY_SECONDS)


def stream_window_summary(spark: SparkSession, folder: str) -> DataFrame:
    runs = run_to_table(
        spark,
        _event_slices(spark, folder),
        lambda stream: sequence_runs(stream.withWatermark("ts", "0 seconds"), "ts", "1 day", 1000 * DAY_SECONDS),
        "window-summary",
    )
    return summary_output(windows.summarise_counts(run_counts(runs), ELEMENTS))


def stream_window_group(spark: SparkSession, folder: str) -> DataFrame:
    """The elements of every window and type, sent in lists while the window is open."""
    slices = _event_slices(spark, folder)

    def grouped(width: str, millis: int) -> DataFrame:
        lists = run_to_table(
            spark,
            slices,
            lambda stream: collect_lists(stream.withWatermark("ts", "0 seconds"), "group_key", "ts", "event_id", width, millis, ELEMENTS),
            "window-group",
        )
        return group_output(lists.withColumnsRenamed({"items": "ids", "size": "items"}), width, F.concat_ws(",", F.col("ids").cast("array<string>")))

    return routing.flatten(*[grouped(width, millis) for width, millis in WIDTHS.items()])


def stream_group_into_batches(spark: SparkSession, folder: str) -> DataFrame:
    batches = run_to_table(
        spark,
        _event_slices(spark, folder),
        lambda stream: collect_batches(
            stream.withWatermark("ts", "0 seconds"), "group_key", "ts", "event_id", DAY_SECONDS
        ),
        "group-into-batches",
    )
    return batch_output(batches)


def stream_load_append(spark: SparkSession, folder: str) -> DataFrame:
    name = new_default_table(spark, batches=True)
    slices = [
        stamped(table(spark, folder, "customer"), "c_custkey", "c_name"),
        stamped(table(spark, folder, "supplier"), "s_suppkey", "s_name"),
    ]
    run_slices(spark, slices, lambda stream: append_loads(stream, name, "batch"), "load-append")
    return loaded_output(spark, name)


STREAM: dict[str, Query] = {
    "stream_seq_book": stream_seq_book,
    "seq_overflow": seq_overflow,
    "seq_overflow_pending": seq_overflow_pending,
    "seq_overflow_age": seq_overflow_age,
    "stream_window_summary": stream_window_summary,
    "stream_window_group": stream_window_group,
    "stream_group_into_batches": stream_group_into_batches,
    "stream_load_append": stream_load_append,
}
