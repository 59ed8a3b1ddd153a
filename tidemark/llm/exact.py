"""Exact dedup in three combines: in each map task, per salted digest, and over the salts.

Texts are equal when they are identical after lower-casing A-Z. The full normalised text is part of the grouping key
at every combine, beside its digest, so that equal digests of different texts never meet. Copies of one text
are spread over salts by their ids, and a map task sends on at most one row per salt and text: a group of
any size reaches the last combine as at most ``salts`` rows.

Of equal texts the row with the largest id stays. Defined cases: a null text counts as empty; null ids
stay only where a group has no other; of repeated rows with one id and text exactly one stays; an empty
table gives an empty result; other columns are ignored by ``dedup`` and kept by ``survivors``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _rows(docs: DataFrame, ident: str, text: str) -> DataFrame:
    norm = normalised(docs[text])
    return docs.select(docs[ident].alias("doc_id"), norm.alias("norm"), F.sha2(norm, 256).alias("text_sha256"))


def winners(docs: DataFrame, ident: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per text: ``text_sha256``, ``check`` (a second digest), ``keep_id`` and ``group_size``."""
    rows = _rows(docs, ident, text).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    salted = rows.groupBy("text_sha256", "salt", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return (
        salted.groupBy("text_sha256", "norm")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .select("text_sha256", F.xxhash64("norm").alias("check"), "keep_id", "group_size")
    )


def dedup(docs: DataFrame, ident: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """Every document with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Documents find their group by both digests of the full text; the joined rows are narrow, and a hot digest is
    one that an adaptive join may split.
    """
    members = _rows(docs, ident, text).select("doc_id", "text_sha256", F.xxhash64("norm").alias("check"))
    copy = F.row_number().over(Window.partitionBy("doc_id", "text_sha256").orderBy("check"))
    return (
        members.withColumn("_copy", copy)
        .join(winners(docs, ident, text, salts), ["text_sha256", "check"])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def survivors(docs: DataFrame, ident: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """The documents that stay, with all their columns.

    One key of digests and id serves the join and the choice among repeated rows, so the texts move once.
    """
    norm = normalised(docs[text])

    def key(sha256: Column, check: Column, id_: Column) -> Column:
        return F.concat_ws(":", sha256, check.cast("string"), F.coalesce(id_.cast("string"), F.lit("null")))

    rows = docs.select(
        F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("doc"),
        key(F.sha2(norm, 256), F.xxhash64(norm), docs[ident]).alias("key"),
    )
    best = winners(docs, ident, text, salts)
    best = best.select(key(F.col("text_sha256"), F.col("check"), F.col("keep_id")).alias("key"))
    copy = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    return rows.join(best, "key", "left_semi").withColumn("copy", copy).filter("copy = 1").select("doc.*")
