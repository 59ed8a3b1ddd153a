from pyspark.sql import functions as F

from tidemark.streaming import replay


def test_slices_keep_all_rows_in_order(spark):
    rows = spark.range(500).select("id", F.timestamp_seconds(F.col("id") * 7).alias("ts"))
    for count in (1, 3, 8, 12):
        slices = replay.time_slices(rows, "ts", count)
        assert len(slices) == count
        found = [sorted(row["id"] for row in part.collect()) for part in slices]
        assert [value for part in found for value in part] == list(range(500))


def test_slices_of_a_burst_have_equal_numbers_of_rows(spark):
    """Nine tenths of the rows come within one of a thousand minutes."""
    micros = F.when(F.col("id") % 10 > 0, F.col("id") * 600).otherwise(F.col("id") * 6_000_000)
    rows = spark.range(10_000).select("id", F.timestamp_micros(micros).alias("ts"))
    sizes = [part.count() for part in replay.time_slices(rows, "ts", 6)]
    assert sum(sizes) == 10_000 and max(sizes) <= 2 * 10_000 / 6
    assert [part.count() for part in replay.time_slices(rows.filter("id < 0"), "ts", 4)] == [0]


def test_hot_keys_ask_for_more_slices(spark, monkeypatch):
    rows = spark.range(100).select(F.when(F.col("id") < 90, 0).otherwise(F.col("id")).alias("k"))
    assert replay.slice_count(rows, "k") == 3
    monkeypatch.setattr(replay, "KEY_ROWS_PER_SLICE", 10)
    assert replay.slice_count(rows, "k") == 9
    monkeypatch.setattr(replay, "ROWS_PER_SLICE", 5)
    assert replay.slice_count(rows, "k") == 20
    assert replay.slice_count(rows.filter("k < 0"), "k", 2) == 2
