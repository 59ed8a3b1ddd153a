from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranges
from tidemark.operators.blocks import value_block


def test_value_block_keeps_order_below_zero(spark):
    blocks = [r[0] for r in spark.range(-9, 9).select(value_block("id", 2)).collect()]
    assert blocks == sorted(blocks) and blocks[0] == -3


def test_number_rows_with_null_and_hot_keys(spark):
    key = F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 > 0, F.concat(F.lit("k"), F.col("id") % 5))
    rows = spark.range(501).select(key.alias("k"), (F.col("id") * 7 % 501 - 100).alias("v"), "id")
    numbered = ranges.number_rows(rows, ["k"], ["v"], "n").collect()
    assert len(numbered) == 501
    for key in {row["k"] for row in numbered}:
        mine = sorted((row["v"], row["n"]) for row in numbered if row["k"] == key)
        assert [n for _, n in mine] == list(range(len(mine)))


def test_running_sums_and_maxima(spark):
    rows = spark.createDataFrame([("a", v, v % 4, v % 7 or None) for v in range(-20, 40)], "k string, v bigint, w bigint, x bigint")
    total, top = 0, None
    found = ranges.running(rows, ["k"], ["v"], {"sum": F.col("w")}, {"top": F.col("x")}).collect()
    for row in sorted(found, key=lambda r: r["v"]):
        total += row["w"]
        top = max(x for x in (top, row["x"]) if x is not None) if row["x"] is not None or top is not None else None
        assert (row["sum"], row["top"]) == (total, top)


def test_empty_table(spark):
    assert ranges.number_rows(spark.range(0), [], ["id"], "n").collect() == []


@pytest.mark.parametrize("rows", [10, 20_000])
def test_one_plan_for_every_size_and_even_ranges_of_bursts(spark, rows):
    """Nine tenths of the rows have one key and one instant."""
    burst = F.col("id") % 10 > 0
    table = spark.range(rows).select(F.when(burst, "hot").otherwise("k").alias("k"), F.when(burst, 5).otherwise(F.col("id")).alias("ts"), "id")
    dealt = ranges.dealt(table, ["k"], ["ts", "id"])
    sizes = Counter(r[0] for r in dealt.select(ranges.RANGE).collect())
    assert max(sizes.values()) <= max(10, 2 * rows / len(sizes))
    numbered = ranges.number_rows(table, ["k"], ["ts", "id"], "n")
    assert "BroadcastHashJoin" in numbered._jdf.queryExecution().executedPlan().toString()
    for key, count in (("hot", rows - rows // 10), ("k", rows // 10)):
        own = sorted((r["ts"], r["id"], r["n"]) for r in numbered.filter(F.col("k") == key).collect())
        assert [n for *_, n in own] == list(range(count))
