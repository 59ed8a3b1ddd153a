"""Mixing sources to target weights: whole copies by repetition rate, the fraction by a seeded coin.

Tokens are summed per source, each source gets a target share of all tokens by its weight, and a document of
a source with rate target / tokens is emitted floor(rate) times plus once more with probability equal to the
fraction. The coin is a hash of the seed and the document's id, so that a rerun takes the same copies.

Defined cases: a null text has no tokens; null is a source like any other and comes last; a source without tokens
has target 0 and is not taken; rows with equal ids toss the same coin; an empty table gives an empty result. Other
columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import written

WORD = r"[^\x20\x09-\x0D]+"
COIN_DIGITS = 13


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_rate: int) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of ``source`` and ``size``; one row per source.

    Sources in code point order, null last, take the weights in turn and share the sum of all sizes. A target stops
    at ``max_rate`` times the source's size; what is above goes to the others by weight. That fills all sources
    to one level of target per weight, but for those that stop below it: in order of size per weight, the level
    left after stopping every earlier source rises while sources stop and falls afterwards, so it is the highest.

    The windows are over the summed sources, one row each.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank - 1) % len(weights) + 1)
    weighted = sources.withColumn("_rank", rank).withColumn("_weight", weight)
    by_room = Window.orderBy(F.col("source_size") / F.col("_weight"), "_rank")
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - max_rate * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    levels = weighted.withColumn("_level", left / F.sum("_weight").over(rest))
    level = F.max("_level").over(Window.orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.select(
        "source",
        "source_size",
        F.least((max_rate * F.col("source_size")).cast("double"), level * F.col("_weight")).alias("target"),
    )


def coin(seed: int, ident: Column) -> Column:
    """A number in [0, 1) that follows from the seed and the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("null")))
    digits = F.substring(F.md5(key), 1, COIN_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(16**COIN_DIGITS)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    max_rate: int = 3,
    seed: int = 20240,
    ident: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per document: ``doc`` (its row as a struct), ``size``, ``source_size``, ``target`` and ``copies``.

    The targets are written as a table, one row per source. Spark sees its size before it plans the join: small, it goes to all
    executors and the documents stay where they are; else the join is shuffled, and a hot source is split there.
    """
    rows = docs.select(
        F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("doc"),
        docs[source].alias("source"),
        word_count(docs[text]).alias("size"),
    )
    targets = written(source_targets(rows.select("source", "size"), weights, max_rate), "mix-targets")
    joined = rows.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_rate))))
    whole = F.floor(F.coalesce(rate, F.lit(0.0)))
    extra = F.coalesce(coin(seed, F.col(f"doc.`{ident}`")) < rate - F.floor(rate), F.lit(False))
    return joined.select(
        "doc", "size", "source_size", "target", (whole + extra.cast("int")).cast("int").alias("copies")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """The documents of ``mix``, each as many times as it has copies, with their own columns."""
    return mixed.select("doc", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("doc.*")
