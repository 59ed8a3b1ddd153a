import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tidemark.llm import toxicity


@pytest.fixture(scope="module")
def made(spark):
    random.seed(8)
    syllables = ["an", "to", "re", "shi", "lo", "mu", "ber", "tion"]
    rows, labels = [], []
    for i in range(900):
        words = ["".join(random.choices(syllables, k=random.randint(1, 4))) for _ in range(random.randint(1, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(random.randint(1, 3)):
                words.insert(random.randint(0, len(words)), random.choice(["vilex", "GRUM,"]) if i % 8 else "krast" + random.choice(syllables))
        rows.append((i, " ".join(words), "en" if i % 8 else "de"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").cache()
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int").cache()


@pytest.fixture(scope="module")
def model(made):
    docs, labels = made
    return toxicity.train(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))


def test_held_out_accuracy(made, model):
    docs, labels = made
    scored = toxicity.score(docs, model).join(labels, "doc_id").filter(toxicity.held_out(F.col("doc_id"))).collect()
    right = sum((r.score >= r.threshold) == bool(r.toxic) for r in scored)
    assert right / len(scored) > 0.97


def test_training_repeats(made, model):
    docs, labels = made
    again = toxicity.train(docs.repartition(5), labels.filter(~toxicity.held_out(F.col("doc_id"))))
    assert np.array_equal(again.embedding, model.embedding)
    assert again.thresholds == model.thresholds


def plain_score(model, text):
    """One text at a time, one window at a time."""
    words = [w.lower() for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", (text or "").encode())]
    numbers, _ = toxicity.block_numbers(np.frombuffer(b" ".join(words), np.uint8), np.array([0, len(b" ".join(words))]))
    rows = model.rows()
    vectors = [model.embedding[rows[n]].sum(0) for n in numbers]
    pooled = []
    for width, weights in model.filters.items():
        windows = [
            sum(vectors[i + j] @ weights[j] for j in range(width) if i + j < len(vectors)) for i in range(len(vectors))
        ]
        pooled.append(np.max(windows, axis=0))
    logit = np.maximum(np.concatenate(pooled) + model.bias, 0) @ model.out + model.out_bias
    return 1 / (1 + np.exp(-logit))


def test_scores_of_odd_rows(spark, model):
    rows = toxicity.score(plain.odd(spark), model).collect()
    assert len(rows) == len(plain.ODD)
    texts = {r[0]: r[1] for r in plain.ODD}
    for row in rows:
        assert row.score == pytest.approx(plain_score(model, texts[row.doc_id]), abs=1e-4)
    assert toxicity.score(plain.none(spark), model).collect() == []


def test_score_sees_the_text_alone(made, model):
    docs, _ = made
    changed = docs.select((F.col("doc_id") + 5000).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"))
    one = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    other = {r.doc_id - 5000: r.score for r in toxicity.score(changed, model).collect()}
    assert one == other


def test_accepted_documents_keep_all_columns(spark, model):
    docs = plain.odd(spark)
    rows = toxicity.accepted(docs, model)
    assert rows.columns == docs.columns
    limits = [r.doc_id for r in toxicity.score(docs, model).collect() if r.score < r.threshold]
    assert sorted((r.doc_id for r in rows.collect()), key=str) == sorted(limits, key=str)
    assert toxicity.accepted(plain.none(spark), model).collect() == []


@pytest.mark.parametrize(("labels", "score"), [([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (2, None), (9999, 1), (None, 1)], 0.0)])
def test_without_both_labels(spark, labels, score):
    model = toxicity.train(plain.odd(spark), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {round(r.score, 6) for r in toxicity.score(plain.odd(spark), model).collect()} == {score}


def test_bounded_sample_keeps_the_share_of_labels(spark, monkeypatch):
    """Words say nothing here, so scores are about the share of toxic rows, 5 %, of which the bound keeps all and of the others a few."""
    monkeypatch.setattr(toxicity, "MAX_LABELLED", 150)
    random.seed(5)
    rows = [(i, " ".join(random.choices(["an", "to", "re", "shi", "lo"], k=20)), "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(3000)], "doc_id long, toxic int")
    scores = [r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()]
    assert 0.02 < np.mean(scores) < 0.1


def test_threshold_of_weighted_rows_equals_repeated_rows():
    random = np.random.default_rng(3)
    labels = random.integers(0, 2, 60).astype(float)
    scores = 0.7 * random.random(60) + 0.3 * labels
    weights = np.where(labels > 0, 1, 8)
    expected = toxicity.best_threshold(np.repeat(scores, weights), np.repeat(labels, weights))
    assert toxicity.best_threshold(scores, labels, weights) == expected
    assert toxicity.best_threshold(scores, labels) < expected


def test_columns_that_clash_with_those_of_the_sample(made):
    docs, labels = made
    clashing = docs.withColumns({name: F.lit("x") for name in ("label", "h", "_id", "toxic")})
    one = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    other = toxicity.score(clashing, toxicity.train(clashing, labels)).collect()
    assert sorted(one) == sorted(other)


def test_learns_from_every_labelled_row(spark, monkeypatch):
    """A few toxic rows have a word of their own; every shard holds few of them, and a bound on rows would leave most out."""
    monkeypatch.setattr(toxicity, "MAX_LABELLED", 200)
    random.seed(6)
    words = [f"rare{i}x" for i in range(80)]
    rows, labels = [], []
    for i in range(2400):
        toxic = i % 3 == 0
        text = random.choices(["an", "to", "re", "shi", "lo", "mu"], k=20)
        if toxic:
            text.insert(3, words[i // 3 % 80])
        rows.append((i, " ".join(text), "en"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    numbers, _ = toxicity.block_numbers(data, np.array([0, len(data)]))
    assert np.isin(numbers[:, 0], model.known).all()
    scores = {r.doc_id: r.score >= r.threshold for r in toxicity.score(docs, model).collect()}
    assert np.mean([scores[i] == bool(kind) for i, kind in labels]) > 0.97
