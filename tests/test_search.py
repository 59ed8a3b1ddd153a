import random

import pytest

from tidemark.operators import search
from tidemark.operators.search import first_within

ROWS = "key string, number bigint, place bigint, value bigint"
QUERIES = "key string, at bigint, bound bigint, label string"


@pytest.mark.parametrize("fan", [4, 16, 256])
def test_against_a_scan(spark, monkeypatch, fan):
    """Keys of one to a few hundred rows, among them the null key, ties, rows without value, and trees of one to four levels."""
    monkeypatch.setattr(search, "FAN", fan)
    random.seed(fan)
    groups = {key: [random.randint(0, size) for _ in range(size)] for key, size in (("a", 1), ("b", 7), (None, 65), ("c", 240))}
    groups["c"][5::9] = [None] * len(groups["c"][5::9])
    rows = [(key, n, 10 * n, value) for key, values in groups.items() for n, value in enumerate(values)]
    asked = [
        (key, random.randint(-1, len(values)), random.randint(-1, len(values)), f"{key} {i}")
        for key, values in groups.items()
        for i in range(60)
    ]
    asked += [("nobody", 0, 5, "no rows"), ("a", None, 5, "no place"), ("a", -1, None, "no bound")]
    expected = {}
    for key, at, bound, label in asked:
        if at is not None and bound is not None:
            hits = [n for n, value in enumerate(groups.get(key, [])) if n > at and value is not None and value <= bound]
            if hits:
                expected[label] = 10 * hits[0]
    found = first_within(spark.createDataFrame(rows, ROWS), spark.createDataFrame(asked, QUERIES), ["key"]).collect()
    assert len(found) == len(expected)
    assert {row["label"]: row["place"] for row in found} == expected


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], ROWS), spark.createDataFrame([("a", 0, 0, 0), ("a", 1, 1, None)], ROWS)
    asked = spark.createDataFrame([("a", -1, 0, "x")], QUERIES)
    assert first_within(none, asked, ["key"]).count() == 0
    assert first_within(some, asked.limit(0), ["key"]).count() == 0
    assert [row["place"] for row in first_within(some, asked, ["key"]).collect()] == [0]
