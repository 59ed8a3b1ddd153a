import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import batching, windows

BASE = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def messages(spark):
    rows = [("a", BASE + dt.timedelta(milliseconds=700 * n), n % 40) for n in range(100)]
    rows += [("b", BASE + dt.timedelta(seconds=n), 5) for n in range(9)]
    return spark.createDataFrame(rows, "group_key string, ts timestamp, sequence bigint")


@pytest.mark.parametrize("size", [10_000, 7])
def test_lists_join_to_the_sorted_sequences(messages, size):
    found = {}
    for row in windows.window_summary(messages, "30 seconds", size).orderBy("list_no").collect():
        key = (row["group_key"], row["window_start"])
        found.setdefault(key, []).append(row)
    expected = {}
    for row in messages.collect():
        second = int((row["ts"] - BASE.replace(tzinfo=None)).total_seconds())
        expected.setdefault((row["group_key"], BASE.replace(tzinfo=None) + dt.timedelta(seconds=second // 30 * 30)), []).append(row)
    assert set(found) == set(expected)
    for key, rows in expected.items():
        lists = found[key]
        assert [row["list_no"] for row in lists] == list(range(-(-len(rows) // size)))
        assert all(len(row["sequences"].split(",")) == size for row in lists[:-1])
        joined = ",".join(row["sequences"] for row in lists)
        assert joined == ",".join(str(s) for s in sorted(r["sequence"] for r in rows))
        assert sum(row["items"] for row in lists) == len(rows)
        assert [row["group_items"] for row in lists] == [len(rows)] + [None] * (len(lists) - 1)
        assert lists[0]["data_from"] == min(r["ts"] for r in rows).strftime("%H:%M:%S.%f")[:-3]
        assert lists[0]["data_to"] == max(r["ts"] for r in rows).strftime("%H:%M:%S.%f")[:-3]
        assert lists[0]["timing"] == "ON_TIME"


def test_summary_from_partial_counts(messages):
    counts = windows.sequence_counts(messages, "30 seconds")
    left = sorted(map(tuple, windows.summarise_counts(counts, 7).collect()), key=str)
    assert left == sorted(map(tuple, windows.window_summary(messages, "30 seconds", 7).collect()), key=str)


def test_windows_are_half_open(spark):
    rows = spark.createDataFrame([(BASE,), (BASE + dt.timedelta(seconds=5),)], "ts timestamp")
    starts = [r[0] for r in windows.assign_windows(rows, "ts", "5 seconds").select("window_start").collect()]
    assert (starts[1] - starts[0]).total_seconds() == 5


def test_guard(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "g int, k string")
    assert sorted(map(tuple, windows.guard_single_key(rows, ["g"], "k").collect())) == [(1, 2), (2, 1)]
    for mixed in ([(1, "a"), (1, "b")], [(1, "a"), (1, None)]):
        with pytest.raises(Exception, match="several keys"):
            windows.guard_single_key(spark.createDataFrame(mixed, "g int, k string"), ["g"], "k").collect()
    nulls = spark.createDataFrame([(1, None), (1, None)], "g int, k string")
    assert windows.guard_single_key(nulls, ["g"], "k").count() == 1


def test_batches(spark):
    rows = spark.range(103).select(F.lit("t").alias("k"), "id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    numbered = batching.number_batches(rows, ["k"], ["id"], 25)
    batches = batching.collect_batches(numbered, ["k"], "id", "name").orderBy("batch_no").collect()
    assert [row["size"] for row in batches] == [25, 25, 25, 25, 3]
    assert [name for row in batches for name in row["items"]] == [f"n{n}" for n in range(103)]
    manifest = batching.export_manifest(
        batching.collect_batches(numbered, ["k"], "id", "name"), ["k"], {"driver": "d"}, "r7"
    ).orderBy("job_name").first()
    assert manifest["job_name"] == "export-r7-t-0" and manifest["parameters"] == {"driver": "d"}
    assert manifest["tables"].split(",")[-1] == "n24"
