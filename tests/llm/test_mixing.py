import random

import pytest

from tests.llm import plain
from tidemark.llm import mixing
from pyspark.sql import functions as F


def source_table(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    return {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long"), (5, 2, 1), 3).collect()}


def test_targets_equal_repeated_resharing(spark):
    random.seed(4)
    for _ in range(8):
        names = random.sample(["a", "b", "Z", "é", "0", None, "aa", "c"], random.randint(1, 8))
        sizes = {name: random.choice([0, 1, 10, 1000, 50_000]) for name in names}
        found, expected = source_table(spark, sizes), plain.targets(sizes)
        assert found.keys() == expected.keys()
        for name, target in expected.items():
            assert found[name] == pytest.approx(target, abs=1e-6)


def test_odd_rows(spark):
    rows = mixing.mix(plain.odd(spark)).select("doc.doc_id", "doc.size", F.col("size").alias("words"), "copies", "source_size", "target").collect()
    assert len(rows) == len(plain.ODD)
    for row in rows:
        text = next(r[1] for r in plain.ODD if r[0] == row.doc_id)
        assert row.words == len(plain.words(text))
        assert 0 <= row.copies <= 3
    assert len({r.copies for r in rows if r.doc_id == 8}) == 1


def test_copies_come_near_the_target_and_repeat(spark):
    rows = [(i, "w " * (1 + i % 17), "abcd"[i % 4] if i % 3 else "a") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    by_source = mixed.groupBy("doc.source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")
    )
    for row in by_source.collect():
        assert row.taken == pytest.approx(row.target, rel=0.05)
    assert mixing.emit(mixed).count() == mixing.emit(mixing.mix(docs)).count()


def test_emitted_rows_have_the_columns_of_the_input(spark):
    docs = plain.odd(spark)
    emitted = mixing.emit(mixing.mix(docs))
    assert emitted.columns == docs.columns
    expected = {r.doc_id: r.copies for r in mixing.mix(docs).select("doc.doc_id", "copies").collect()}
    counts = {r.doc_id: r["count"] for r in emitted.groupBy("doc_id").count().collect()}
    assert counts == {i: n * (2 if i == 8 else 1) for i, n in expected.items() if n}


def test_empty_table(spark):
    assert mixing.emit(mixing.mix(plain.none(spark))).collect() == []
