"""Tumbling windows, grouping by key and window, and the per-window summary.

A window of a hot key can hold any share of the table, so its elements never form one array: they are
combined by value, placed by a running count over ranges of rows, and written as lists of at
most ``list_size`` elements (``list_no`` 0, 1, …). What is said of the whole group stands on its list 0 alone, so that sums
over the lists count every element once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ranges

LIST_SIZE = 1000
CLOCK_FORMAT = "HH:mm:ss.SSS"


def assign_windows(df: DataFrame, ts: str, width: str) -> DataFrame:
    """Add ``window_start`` and ``window_end`` of the epoch-aligned tumbling window; no shuffle."""
    window = F.window(F.col(ts), width)
    return df.withColumn("_window", window).select(
        "*", F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end")
    ).drop("_window")


def value_lists(counts: DataFrame, keys: Sequence[str], value: str, list_size: int = LIST_SIZE) -> DataFrame:
    """Sorted, comma-joined values of every group, in lists of at most ``list_size``, with their number ``items``.

    ``counts`` has one row per (keys, value) with its number of copies ``n``.
    """
    placed = ranges.running(counts, keys, [value], {"_stop": F.col("n")}).withColumn("_start", F.col("_stop") - F.col("n"))
    size = F.lit(list_size)
    first = F.floor(F.col("_start") / size)
    last = F.floor((F.col("_stop") - 1) / size)
    pieces = placed.withColumn("list_no", F.explode(F.sequence(first, last))).withColumn(
        "_take",
        F.least((F.col("list_no") + 1) * size, F.col("_stop")) - F.greatest(F.col("list_no") * size, F.col("_start")),
    )
    lists = pieces.groupBy(*keys, "list_no").agg(
        F.sort_array(F.collect_list(F.struct(F.col(value).alias("value"), F.col("_take").cast("int").alias("take")))).alias("runs"),
        F.sum("_take").cast("bigint").alias("items"),
    )
    repeated = F.flatten(F.transform("runs", lambda run: F.array_repeat(run["value"].cast("string"), run["take"])))
    return lists.withColumn(value, F.concat_ws(",", repeated)).drop("runs")


def group_by_window(
    df: DataFrame, key: str, ts: str, width: str, element: str, list_size: int = LIST_SIZE
) -> DataFrame:
    """Elements (an integer id) of every (key, window), in id order; rows without key are a group too."""
    keys = ["window_start", "window_end", key]
    counts = assign_windows(df, ts, width).groupBy(*keys, element).agg(F.count(F.lit(1)).alias("n"))
    return value_lists(counts, keys, element, list_size)


_GROUP = ["window_start", "window_end", "group_key"]


def sequence_counts(messages: DataFrame, width: str) -> DataFrame:
    """Partial summary: one row per (window, group_key, sequence).

    Works on batch and streaming messages (group_key, ts, sequence) alike; it is the only grouping a
    stream needs, as ``summarise_counts`` finishes it from whatever sink it was written to.
    """
    window = F.window("ts", width)
    return (
        messages.groupBy(window.alias("window"), "group_key", "sequence")
        .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "group_key",
            "sequence",
            "n",
            "first_ts",
            "last_ts",
        )
    )


def summarise_counts(counts: DataFrame, list_size: int = LIST_SIZE) -> DataFrame:
    """Lists of sorted sequences of every (window, group_key), from rows of ``sequence_counts``.

    List 0 also has the group's number of elements, data range and window range.
    """
    totals = counts.groupBy(*_GROUP).agg(
        F.sum("n").alias("group_items"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )
    totals = totals.select(*[F.col(name).alias(f"_t_{name}") for name in _GROUP], "group_items", "first_ts", "last_ts")
    lists = value_lists(counts.select(*_GROUP, "sequence", "n"), _GROUP, "sequence", list_size)
    first = (F.col("list_no") == 0) & ranges.same(_GROUP, "_t_")
    clock = lambda name: F.date_format(name, CLOCK_FORMAT)
    on_first = lambda column: F.when(F.col("list_no") == 0, column)
    return lists.join(totals, first, "left").select(
        "group_key",
        "window_start",
        "window_end",
        "list_no",
        "items",
        "group_items",
        clock("first_ts").alias("data_from"),
        clock("last_ts").alias("data_to"),
        on_first(clock("window_start")).alias("window_from"),
        on_first(clock("window_end")).alias("window_to"),
        F.col("sequence").alias("sequences"),
        F.lit("ON_TIME").alias("timing"),
    )


def window_summary(messages: DataFrame, width: str, list_size: int = LIST_SIZE) -> DataFrame:
    """Lists and group totals of every (window, group_key)."""
    return summarise_counts(sequence_counts(messages, width), list_size)


def guard_single_key(df: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    """Rows per group; raises if a group mixes values of ``key`` (NULL counts as a value)."""
    mixed = (F.min(key) != F.max(key)) | F.count_if(F.col(key).isNull()).between(1, F.count(F.lit(1)) - 1)
    checked = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("items"), F.coalesce(mixed, F.lit(False)).alias("_mixed")
    )
    return checked.filter(F.assert_true(~F.col("_mixed"), F.lit("a group holds several keys")).isNull()).drop("_mixed")
