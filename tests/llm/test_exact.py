from collections import Counter

from pyspark.sql import functions as F

from tests.llm import plain
from tidemark.llm import exact


def expected(rows):
    groups: dict = {}
    for row in rows:
        groups.setdefault(plain.folded(row[1]), []).append(row[0])
    result = Counter()
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            result[(i, keep, len(ids), i == keep and not kept)] += 1
            kept = kept or i == keep
    return result


def test_odd_rows(spark):
    found = exact.dedup(plain.odd(spark)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found) == expected(plain.ODD)


def test_equal_digests_of_different_texts_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(exact.F, "sha2", lambda column, bits: F.lit("same"))
    found = exact.dedup(plain.odd(spark)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == Counter(
        {k[:3]: 0 for k in expected(plain.ODD)} | Counter(k[:3] for k in expected(plain.ODD).elements())
    )


def test_one_hot_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "Hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    found = exact.dedup(docs)
    assert found.filter("kept").count() == 1001
    assert found.filter("group_size = 2000").select("keep_id").distinct().collect()[0][0] == 2999


def test_survivors_keep_all_columns(spark):
    docs = plain.odd(spark)
    kept = exact.survivors(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k[0] for k in expected(plain.ODD) if k[3])
    assert exact.survivors(plain.none(spark)).collect() == exact.dedup(plain.none(spark)).collect() == []
