import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tidemark.llm import sharding


def shards(docs, **how):
    dimensions = {"n_chars": docs.n_chars, "lang": sharding.text_place(docs.lang)}
    return sharding.kd_shards(docs, dimensions, **how)


@pytest.mark.parametrize("count", [1, 3, 8])
def test_odd_rows(spark, count):
    rows = shards(plain.odd(spark), shards=count).collect()
    expected = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in plain.ODD)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    slots: dict = {}
    for row in rows:
        assert 0 <= row.shard < count
        slots.setdefault(row.shard, []).append(row.slot)
    assert all(sorted(one) == list(range(len(one))) for one in slots.values())


def test_empty_table(spark):
    assert shards(plain.none(spark), target_bytes=100).collect() == []


@pytest.fixture(scope="module")
def many(spark):
    text = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.repeat(F.lit("ab"), F.pmod(F.hash("id"), F.lit(50))), (F.col("id") % 700).cast("string")))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), text.alias("text"), F.element_at(F.array(F.lit("de"), F.lit("en"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("lang"))
    return docs.withColumn("n_chars", F.length("text")).cache()


def test_bytes_are_near_equal_and_light_groups_stay_together(many):
    rows = shards(many, shards=8).collect()
    sizes = Counter()
    for row in rows:
        sizes[row.shard] += row.size
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8
    assert all(abs(size - mean) < 0.05 * mean for size in sizes.values())
    texts = {r.doc_id: (r.text, r.lang) for r in many.collect()}
    groups: dict = {}
    for row in rows:
        groups.setdefault(texts[row.doc_id], set()).add(row.shard)
    assert [key for key, where in groups.items() if len(where) > 1 and key[0] != "hot"] == []


def test_leaves_follow_the_target(many):
    total = shards(many, shards=1).agg(F.sum("size")).first()[0]
    found = shards(many, target_bytes=total // 5).groupBy("shard").count().count()
    assert found in (5, 6)


def test_shards_are_boxes(spark):
    docs = spark.range(512).select(
        F.col("id").alias("doc_id"), F.lit("same size").alias("text"), (F.col("id") % 32).alias("a"), F.floor(F.col("id") / 32).alias("b")
    )
    rows = sharding.kd_shards(docs, {"a": docs.a, "b": docs.b}, shards=4).collect()
    for shard in range(4):
        own = [r.doc_id for r in rows if r.shard == shard]
        a, b = {i % 32 for i in own}, {i // 32 for i in own}
        assert len(own) == len(a) * len(b) == 128
