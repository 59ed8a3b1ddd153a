"""How often each sequence of a window and key has come, as a stateful stream operator on runs.

Sequences that came equally often and follow each other are one run (low, high, copies), so the state of an open window has as many entries as its
sequences have holes and changes in number, not one for each message. A micro-batch is merged by a sweep over the ends of runs. Keys are dealt into buckets
with blocks of ``2**BLOCK_BITS`` sequences, so that one key's runs are held by many tasks. When the watermark passes a window's end its runs are sent.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.blocks import value_block
from tidemark.session import ship_by_value
from tidemark.streaming.batches import BUCKETS_PER_PARTITION, OpenWindows, bucket, key_type

BLOCK_BITS = 16
_GROUP = ["group_key", "window_millis", "block"]
_TIMES = ["first_us", "last_us"]


def merge_runs(open_: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Runs (``_GROUP``, ``low``, ``high``, ``n``, ``_TIMES``) with the rows (``_GROUP``, ``sequence``, ``at``) added; times are those of the group."""
    came = rows.rename(columns={"sequence": "low"}).assign(high=rows["sequence"], n=1, first_us=rows["at"], last_us=rows["at"])
    both = pd.concat([open_, came[open_.columns]], ignore_index=True)
    code = both.groupby(_GROUP, sort=False, dropna=False).ngroup().to_numpy()
    groups = both[_GROUP].drop_duplicates(ignore_index=True)
    times = both.groupby(code).agg(first_us=("first_us", "min"), last_us=("last_us", "max"))
    # Every run adds its copies from its low end on and takes them off after its high end.
    place = np.concatenate([both["low"], both["high"] + 1])
    owner, change = np.tile(code, 2), np.concatenate([both["n"], -both["n"]])
    order = np.lexsort((place, owner))
    place, owner, change = place[order], owner[order], change[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(owner) != 0)]))
    place, owner, change = place[first], owner[first], np.add.reduceat(change, first)
    turns = change != 0
    place, owner, change = place[turns], owner[turns], change[turns]
    copies = np.cumsum(change)  # 0 after the last end of every group
    held = np.flatnonzero(copies[:-1])
    runs = groups.loc[owner[held]].reset_index(drop=True).assign(low=place[held], high=place[held + 1] - 1, n=copies[held])
    for name in _TIMES:
        runs[name] = times[name].to_numpy()[owner[held]]
    return runs


class RunCounter(OpenWindows):
    """Sends the runs of a window when the watermark passes its end."""

    def __init__(self, window_millis: int, group_type: pa.DataType):
        longs = ["window_millis", "block", "low", "high", "n", *_TIMES]
        super().__init__(window_millis, pa.schema([("group_key", group_type), *[(name, pa.int64()) for name in longs]]))

    def add(self, open_: pd.DataFrame, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        return merge_runs(open_, rows), open_[:0]

    def over(self, ended: pd.DataFrame) -> pd.DataFrame:
        return ended[self.schema.names]


ship_by_value(__name__)


def sequence_runs(
    messages: DataFrame, ts: str, width: str, window_millis: int, buckets_per_partition: int = BUCKETS_PER_PARTITION
) -> DataFrame:
    """Runs of sequences per window and key of watermarked messages (group_key, ts, sequence): window_start, window_end, group_key, low, high, n, first_ts,
    last_ts; append mode. Rows without sequence are no messages."""
    output = T.StructType(
        [T.StructField("group_key", messages.schema["group_key"].dataType)]
        + [T.StructField(name, T.LongType()) for name in ("window_millis", "block", "low", "high", "n", *_TIMES)]
    )
    flat = messages.filter(F.col("sequence").isNotNull()).select(
        "group_key",
        F.unix_millis(F.window(F.col(ts), width)["start"]).alias("window_millis"),
        value_block("sequence", BLOCK_BITS).alias("block"),
        F.col("sequence").cast("bigint").alias("sequence"),
        F.unix_micros(F.col(ts)).alias("at"),
        bucket(messages, buckets_per_partition, F.col("group_key"), value_block("sequence", BLOCK_BITS)),
        ts,
    )
    runs = flat.groupBy("bucket").transformWithStateInPandas(
        RunCounter(window_millis, key_type(messages, "group_key")), output, "Append", "EventTime"
    )
    return runs.select(
        F.timestamp_millis("window_millis").alias("window_start"),
        F.timestamp_millis(F.col("window_millis") + window_millis).alias("window_end"),
        "group_key",
        "low",
        "high",
        "n",
        F.timestamp_micros("first_us").alias("first_ts"),
        F.timestamp_micros("last_us").alias("last_ts"),
    )


def run_counts(runs: DataFrame) -> DataFrame:
    """The rows of ``operators.windows.sequence_counts`` that the runs stand for."""
    return runs.withColumn("sequence", F.explode(F.sequence("low", "high"))).drop("low", "high")
