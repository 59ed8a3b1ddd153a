"""The registered corpus queries on the smallest tables: SQL where there is some, else plain Python."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import difference, duck
from tests.llm import plain
from tests.llm.test_near_copies import groups
from tests.llm.test_packing import TOKENIZER, check_layout
from tests.llm.test_toxicity import plain_score
from tidemark.llm import mixing, queries, toxicity
from tidemark.llm.tables import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", queries.ORACLE)
def test_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.ORACLE[name]) is None


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_repeated_passages(spark, texts):
    rows = queries.op3_repeated_passages(spark, FOLDER).collect()
    assert sorted(map(tuple, rows)) == sorted(plain.without_repeats(list(texts.items())))


def test_near_duplicates(spark, texts):
    rows = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash_near_dedup(spark, FOLDER).collect()}
    prints = [plain.simhash(text) for text in texts.values()]
    least = plain.least_linked(prints, list(texts))
    assert rows == {i: (f"{p:016x}", c) for i, p, c in zip(texts, prints, least, strict=True)}


def test_toxicity_columns(spark, texts):
    rows = queries.op10_toxicity(spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == texts.keys()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
        assert row.predicted == (row.score >= 0.3)


def test_secret_scan_flags_no_candidate_twice(spark, texts):
    rows = queries.op2_secret_scan(spark, FOLDER).collect()
    assert len({(r.doc_id, r.start) for r in rows}) == len(rows)


def test_pipeline(spark, texts):
    docs = table(spark, FOLDER, "documents")
    model = queries.toxicity_model(docs, table(spark, FOLDER, "labels"))
    langs = {r.doc_id: r.lang for r in docs.collect()}
    clean = {i: t for i, t in texts.items() if plain_score(model, t) < model.thresholds.get(langs[i], model.common)}
    last = {plain.folded(t): i for i, t in sorted(clean.items())}
    single = {i: clean[i] for i in last.values()}
    least = groups(list(single.items()))
    apart = {i: single[i] for i in set(least)}
    sources = {r.doc_id: r.source for r in docs.collect()}
    sizes: dict = {}
    for i, t in apart.items():
        sizes[sources[i]] = sizes.get(sources[i], 0) + len(plain.words(t))
    targets = plain.targets(sizes)
    coins = {r.doc_id: r.coin for r in docs.select("doc_id", mixing.coin(20240, F.col("doc_id")).alias("coin")).collect()}
    expected = Counter()
    for i, t in apart.items():
        rate = targets[sources[i]] / sizes[sources[i]]
        copies = int(rate) + (coins[i] < rate - int(rate))
        ids = TOKENIZER.encode(t, add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            if copies:
                expected[(i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += copies
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    assert check_layout(rows, 4096) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_stages_keep_the_columns(spark):
    docs = table(spark, FOLDER, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns


def test_held_out_is_the_remainder_of_the_checksum(spark):
    rows = spark.range(50).select("id", toxicity.held_out(F.col("id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
