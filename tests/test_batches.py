"""Lists of limited size cut on arrays, micro-batch by micro-batch, against plain lists."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.streaming.batches import _GROUP, collect_lists, cut_lists
from tidemark.streaming.replay import run_to_table

EMPTY = pd.DataFrame({"group_key": pd.Series(dtype=object), "window_millis": np.zeros(0, np.int64), "made": np.zeros(0, np.int64), "items": pd.Series(dtype=object)})


@pytest.mark.parametrize("size", [1, 3, 25])
def test_equals_plain_lists(size):
    random.seed(size)
    open_, sent, expected = EMPTY, {}, {}
    for _ in range(12):
        rows = [(random.choice(["a", "b", None]), random.choice([0, 5000]), random.randint(-50, 50)) for _ in range(random.randint(1, 40))]
        open_, lists = cut_lists(open_, pd.DataFrame(rows, columns=[*_GROUP, "item"]), size)
        for row in lists.itertuples():
            assert (row.group_key, row.window_millis, row.list_no) not in sent
            sent[row.group_key, row.window_millis, row.list_no] = row.items.tolist()
        for key, window, item in sorted(rows, key=lambda r: r[2]):
            expected.setdefault((key, window), []).append(item)
    assert all(len(items) == size for items in sent.values())
    rest = {(r.group_key, r.window_millis): (r.made, list(r.items)) for r in open_.itertuples()}
    assert all(len(items) < size for _, items in rest.values())
    for group, items in expected.items():
        made, left = rest[group]
        assert [x for n in range(made) for x in sent[*group, n]] + left == items


def test_stream_sends_full_lists_before_the_window_ends_and_drops_late_rows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(n, base + dt.timedelta(seconds=n), "hot" if n % 3 else None) for n in range(60)]
    frame = spark.createDataFrame(rows, "id bigint, ts timestamp, k string")
    slices = [frame.filter(F.col("id").between(low, high)) for low, high in ((0, 24), (25, 39), (40, 59))]
    late = spark.createDataFrame([(99, base, "hot")], "id bigint, ts timestamp, k string")
    lists = run_to_table(
        spark,
        [*slices, late],
        lambda stream: collect_lists(stream.withWatermark("ts", "0 seconds"), "k", "ts", "id", "30 seconds", 30_000, 4, 2),
        "lists",
    )
    found = {(r["group_key"], r["window_start"], r["list_no"]): r["items"] for r in lists.collect()}
    for key in ("hot", None):
        for window in (0, 30):
            own = [n for n, _, k in rows if k == key and window <= n < window + 30]
            start = base + dt.timedelta(seconds=window)
            parts = [items for (k, w, _), items in sorted(found.items(), key=str) if k == key and w == start]
            # The second window is still open: only its full lists are there.
            assert [x for part in parts for x in part] == (own if window == 0 else own[: len(own) // 4 * 4])
