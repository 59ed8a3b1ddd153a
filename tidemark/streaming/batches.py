"""Lists of limited size per key and window, as a stateful stream operator.

Serves batches of a few elements and the element lists of whole windows alike. Keys are dealt into buckets, and a bucket is one key of the operator: its state is one
Arrow batch with a row per open (key, window) that holds the number of lists made and the elements of the next, fewer than the list's size. A micro-batch is
added by array operations. A list is sent as soon as it is full, the rest when the watermark passes the window's end; for that a bucket has one timer at a
time, at the earliest end of its open windows.

Elements are in order inside a micro-batch, and those of an earlier micro-batch come first. Rows without key are a key of their own.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.batching import BATCH_SIZE
from tidemark.session import ship_by_value

BUCKETS_PER_PARTITION = 16
_GROUP = ["group_key", "window_millis"]


def cut_lists(open_: pd.DataFrame, rows: pd.DataFrame, size: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Open groups (``_GROUP``, ``made``, ``items``) with the rows (``_GROUP``, ``item``) added, and the lists that got full.

    A group that is left without elements stays open with its number of lists.
    """
    rows = rows.sort_values("item", kind="stable")
    waiting = open_["items"].map(len).to_numpy(np.int64)
    both = pd.concat([open_.loc[np.repeat(open_.index, waiting), _GROUP], rows[_GROUP]], ignore_index=True)
    groups = pd.concat([open_[_GROUP], rows[_GROUP]], ignore_index=True).drop_duplicates(ignore_index=True)
    made = np.zeros(len(groups), np.int64)
    made[: len(open_)] = open_["made"]
    code = groups.assign(code=np.arange(len(groups))).merge(both.reset_index(), on=_GROUP, how="right").sort_values("index")["code"].to_numpy()
    item = np.concatenate([*open_["items"], rows["item"].to_numpy()])
    order = np.argsort(code, kind="stable")
    code, item = code[order], item[order]
    counts = np.bincount(code, minlength=len(groups))
    starts = np.cumsum(counts) - counts
    full = counts // size
    is_full = np.arange(len(code)) - starts[code] < full[code] * size
    owner = np.repeat(np.arange(len(groups)), full)
    number = np.arange(len(owner)) - (np.cumsum(full) - full)[owner] + made[owner]
    lists = groups.loc[owner].reset_index(drop=True).assign(list_no=number, items=list(item[is_full].reshape(-1, size)))
    rest = np.split(item[~is_full], np.cumsum(counts - full * size)[:-1]) if len(groups) else []
    return groups.assign(made=made + full, items=rest), lists


class OpenWindows(StatefulProcessor):
    """What the open windows of a bucket hold, as one Arrow batch, and a timer at the earliest of their ends.

    A subclass adds the rows of a micro-batch with ``add``, which also returns what is sent at once, and sends what windows that are over hold with ``over``.
    """

    def __init__(self, window_millis: int, schema: pa.Schema):
        self.window_millis = window_millis
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "batch binary")

    def _open(self) -> pd.DataFrame:
        stored = self.state.get()
        table = pa.ipc.open_stream(stored[0]).read_all() if stored else self.schema.empty_table()
        return table.to_pandas()

    def _keep(self, open_: pd.DataFrame) -> None:
        if not len(open_):
            self.state.clear()
            return
        out = io.BytesIO()
        with pa.ipc.new_stream(out, self.schema) as writer:
            writer.write_table(pa.Table.from_pandas(open_, self.schema, preserve_index=False))
        self.state.update((out.getvalue(),))
        self.handle.registerTimer(int(open_["window_millis"].min()) + self.window_millis)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        open_, sent = self.add(self._open(), pd.concat(list(rows), ignore_index=True))
        self._keep(open_)
        if len(sent):
            yield sent

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        open_ = self._open()
        over = open_["window_millis"] + self.window_millis <= timerValues.getCurrentWatermarkInMs()
        self._keep(open_[~over])
        sent = self.over(open_[over])
        if len(sent):
            yield sent


class ListCollector(OpenWindows):
    """Sends full lists at once and the rest of a group when the watermark passes its window's end."""

    def __init__(self, size: int, window_millis: int, key_type: pa.DataType):
        self.size = size
        fields = [("group_key", key_type), ("window_millis", pa.int64()), ("made", pa.int64()), ("items", pa.list_(pa.int64()))]
        super().__init__(window_millis, pa.schema(fields))

    def add(self, open_: pd.DataFrame, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        open_, lists = cut_lists(open_, rows, self.size)
        return open_, _sent(lists)

    def over(self, ended: pd.DataFrame) -> pd.DataFrame:
        return _sent(ended[ended["items"].map(len) > 0].rename(columns={"made": "list_no"}))


def _sent(lists: pd.DataFrame) -> pd.DataFrame:
    return lists.assign(size=lists["items"].map(len).astype("int64"))[[*_GROUP, "list_no", "size", "items"]]


ship_by_value(__name__)


def bucket(rows: DataFrame, per_partition: int, *by: Column) -> Column:
    """The bucket of a row; the number of buckets follows that of the state partitions, which a checkpoint fixes as well."""
    buckets = per_partition * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.pmod(F.xxhash64(*by), F.lit(buckets)).alias("bucket")


def key_type(rows: DataFrame, key: str) -> pa.DataType:
    return pa.int64() if isinstance(rows.schema[key].dataType, T.IntegralType) else pa.string()


def collect_lists(
    rows: DataFrame,
    key: str,
    ts: str,
    item: str,
    width: str,
    window_millis: int,
    size: int,
    buckets_per_partition: int = BUCKETS_PER_PARTITION,
) -> DataFrame:
    """Lists of ``item`` (an integer) per key and tumbling window of a watermarked stream: group_key, window_start, list_no, size, items; append mode."""
    output = T.StructType(
        [
            T.StructField("group_key", rows.schema[key].dataType),
            T.StructField("window_millis", T.LongType()),
            T.StructField("list_no", T.LongType()),
            T.StructField("size", T.LongType()),
            T.StructField("items", T.ArrayType(T.LongType())),
        ]
    )
    # Windows are whole milliseconds here, as times without zone would depend on that of the Python worker.
    flat = rows.select(
        F.col(key).alias("group_key"),
        F.unix_millis(F.window(F.col(ts), width)["start"]).alias("window_millis"),
        F.col(item).cast("bigint").alias("item"),
        bucket(rows, buckets_per_partition, F.col(key)),
        ts,
    )
    lists = flat.groupBy("bucket").transformWithStateInPandas(
        ListCollector(size, window_millis, key_type(rows, key)), output, "Append", "EventTime"
    )
    return lists.select("group_key", F.timestamp_millis("window_millis").alias("window_start"), "list_no", "size", "items")


def collect_batches(
    rows: DataFrame, key: str, ts: str, item: str, window_seconds: int, size: int = BATCH_SIZE
) -> DataFrame:
    """Batches of ``item`` per key and tumbling window of a watermarked stream; append mode."""
    lists = collect_lists(rows, key, ts, item, f"{window_seconds} seconds", window_seconds * 1000, size)
    return lists.withColumnRenamed("list_no", "batch_no")
