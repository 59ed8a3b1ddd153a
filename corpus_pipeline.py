"""From raw documents to packed training sequences: filter, dedup, mix, pack.

Every stage takes the documents that its predecessor left, written as Parquet and read again, and its decisions take effect:
what it rejects is gone, what it repeats is there as often. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact, mixing, near_copies, packing, queries, toxicity
from tidemark.llm.tables import table, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language; trained on labelled documents of this input."""
    model = queries.toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of every group of equal texts."""
    return exact.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group linked by five-word shingles with Jaccard similarity 0.8 or more.

    Links come from SimHash fingerprints, confirmed on the shingles; those whose fingerprints are farther apart from the shingles themselves.
    """
    return near_copies.survivors(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as its source's repetition rate asks for."""
    return mixing.emit(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequence and place in it."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: SQL can't express the classifier, the fingerprints or the packing; tests/llm compares with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
