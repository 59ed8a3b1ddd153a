"""The registered corpus queries and their SQL."""

from __future__ import annotations

import json
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    embedding_cells,
    exact,
    mixing,
    order_minhash,
    packing,
    repeats,
    secrets,
    sharding,
    simhash,
    spelling,
    toxicity,
    warc,
)
from tidemark.llm.tables import table, written


def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
    )


def findings_label() -> Column:
    """Labels for candidates, as the tables have none: the reviewer's rule that a value is a secret if it has the format of a cloud access key or is
    assigned to a name for credentials; all other candidates are false positives."""
    is_key = F.col("value").rlike("^AKIA[A-Z0-9]{16}$")
    is_assigned = F.col("before").rlike(r"(?i)(password|passwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?$")
    return (is_key | is_assigned).cast("int")


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All candidates with their scores; labels are learnt only from documents that are not held out."""
    docs = table(spark, folder, "documents")
    vocabulary = json.loads(Path(public_tokenizers.path("word_bpe_49k.json")).read_text())["model"]["vocab"]
    dictionary = [word.removesuffix("</w>") for word in vocabulary if word.endswith("</w>") and word[:-4].isalpha()]
    found = written(secrets.candidates(docs, dictionary), "candidates")
    held_out = F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False))
    forest = secrets.train(found.filter(~held_out), findings_label())
    return secrets.score(found, forest).select(
        "doc_id", "start", "length", "value_sha256", "score", (F.col("score") >= 0.5).alias("is_secret"), held_out.alias("held_out")
    )


def op3_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.dedup(table(spark, folder, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op5_warc_histories(spark: SparkSession, folder: str) -> DataFrame:
    """``pages`` has no capture times; its rows are taken as captured one second apart in order of id."""
    pages = table(spark, folder, "pages")
    captured_at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id"))
    return warc.histories(pages, captured_at).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.dedup(table(spark, folder, "documents"))


def op8_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``bytes``: near equal bytes in eight shards, by size, characters and language."""
    docs = table(spark, folder, "documents")
    dimensions = {
        "bytes": F.octet_length("text"),
        "n_chars": F.col("n_chars"),
        "lang": sharding.text_place(F.col("lang")),
    }
    return sharding.kd_shards(docs, dimensions, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.compare_with_next(table(spark, folder, "documents"))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Trained on the labelled documents that are not held out."""
    known = labels.select("doc_id", "toxic").filter(~toxicity.held_out(F.col("doc_id")))
    return toxicity.train(docs, known)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity_model(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "threshold",
    )


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return alignment.alignments(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_cells.near_duplicates(table(spark, folder, "embeddings"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, folder, "documents"), edit=spelling.erased))


QUERIES = {
    "op1_source_mix": op1_source_mix,
    "op2_secret_scan": op2_secret_scan,
    "op3_repeated_passages": op3_repeated_passages,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_warc_histories": op5_warc_histories,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_kd_shards": op8_kd_shards,
    "op9_order_minhash": op9_order_minhash,
    "op10_toxicity": op10_toxicity,
    "op11_token_alignment": op11_token_alignment,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE = {
    "op1_source_mix": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
            FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END
                       AS weight,
                   row_number() OVER (ORDER BY source NULLS LAST) AS place
            FROM sized GROUP BY source),
        levels AS (
            SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
                          ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (ORDER BY source_size / weight, place
                                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM sources),
        targets AS (
            SELECT source, source_size,
                   least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * weight) AS target
            FROM levels),
        rated AS (
            SELECT doc_id, size, source_size, target,
                   CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0 END AS rate,
                   CAST('0x' || substr(md5('20240:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
                       / 4503599627370496 AS coin
            FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST((floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
        FROM rated""",
    "op5_warc_histories": """
        WITH bodies AS (
            SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
        firsts AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM bodies)
        SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
                   (CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT)
                       >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1) FOR i IN range(32)], '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM firsts""",
    "op7_exact_dedup": """
        WITH folded AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                       AS norm
            FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(norm) AS text_sha256
        FROM folded""",
}
