import pytest
from pyspark.sql import functions as F

from tidemark.llm.tables import least_hashed


@pytest.mark.parametrize("rows", [0, 5, 100, 5000])
def test_smallest_hashes(spark, rows):
    hashed = spark.range(rows).select("id", F.xxhash64("id").alias("h"))
    expected = sorted(r.h for r in hashed.collect())[:100]
    assert [r.h for r in least_hashed(hashed, "h", 100).collect()] == expected


def test_one_hash_of_very_many_rows(spark):
    hashed = spark.range(5000).select("id", F.lit(2**62).alias("h"))
    assert least_hashed(hashed, "h", 100).count() == 100
