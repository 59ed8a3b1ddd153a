"""Spelling variants: words one edit apart, found by asymmetric chunks, and the frequent form each rare one stands for.

Of two words one edit apart the shorter (of equally long ones the smaller) contributes two disjoint chunks, its halves. One edit
leaves a half whole, and the other word has it at the same place or shifted by one: at the same distance from the end. So the other word
contributes its positional grams of these lengths at those places. The half that holds the edit is halved again in the same way, so that
a key has the length, the whole half and the whole quarter: words sharing a frequent half don't meet by it alone. Words join by the hash of their
keys, and the Levenshtein distance of every pair found decides. All of it is DataFrame functions.

Words are the maximal runs of ``LETTERS`` in whole texts, in lower case for A-Z only, of at least ``least_length`` code points, that occur at least
``least_count`` times in all. ``erased`` may take a code point out of some occurrences; it makes the variants of the registered query.

A word's form is its near word with the largest count (of ties the smallest in code-point order), where that count is at least ``ratio`` times its own;
its root is the last form of the chain. Counts rise by ``ratio`` along a chain, so it has no cycle and doubling ends in a few rounds.

Defined cases: null and empty texts have no words; a null id counts like any other row (``erased`` takes it as an empty text); repeated rows
count as often as they are there; a run of any length is one word; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import written

LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
ERASED_OF = 31


def erased(doc_id: Column, run: Column) -> Column:
    """The run, without one code point where ``ERASED_OF`` divides the checksum of id and run."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    place = F.pmod(check, F.char_length(run)).cast("int")
    rest = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.char_length(run)))
    return F.when(F.pmod(check, F.lit(ERASED_OF)) == 0, rest).otherwise(run)


def word_counts(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    edit: Callable[[Column, Column], Column] | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word`` and ``n``; occurrences are counted in the map tasks first."""
    runs = F.regexp_extract_all(docs[text], F.lit(LETTERS + "{%d,}+" % least_length), F.lit(0))
    rows = docs.select(docs[ident].alias("doc_id"), F.explode(runs).alias("run"))
    low = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    rows = rows.select("doc_id", low.alias("word"))
    if edit is not None:
        rows = rows.select(edit(F.col("doc_id"), F.col("word")).alias("word"))
    counted = rows.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _part(word: Column, start: Column, end: Column) -> Column:
    return F.substring(word, (start + 1).cast("int"), (end - start).cast("int"))


def _keys(word: Column, length: Column, longer: int) -> list[Column]:
    """The hashes of half and quarter, as a word has them that is ``longer`` than the ``length`` that sets the chunks (0 for the chunks themselves)."""
    end = length + longer
    half = F.floor(length / 2)
    kept_first, kept_last = _part(word, F.lit(0), half), _part(word, half + longer, end)
    late, early = half + F.floor((length - half) / 2), F.floor(half / 2)
    parts = [
        (kept_first, _part(word, half, late)),
        (kept_first, _part(word, late + longer, end)),
        (kept_last, _part(word, F.lit(0), early)),
        (kept_last, _part(word, early + longer, half + longer)),
    ]
    return [F.xxhash64(length.cast("int"), F.lit(kind), *pair) for kind, pair in enumerate(parts)]


def near_pairs(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b``: every pair of words with one edit between them, once."""
    length = F.char_length("word")
    chunks = words.select(
        F.explode(F.array(*_keys(F.col("word"), length, 0))).alias("key"), F.col("word").alias("a"), F.col("n").alias("n_a")
    )
    same, shifted = _keys(F.col("word"), length, 0), _keys(F.col("word"), length - 1, 1)
    grams = F.when(length > least_length, F.array(*same, *shifted)).otherwise(F.array(*same))
    positional = words.select(F.explode(grams).alias("key"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    ordered = (F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b"))
    met = chunks.join(positional, "key").filter(ordered & (F.char_length("a") <= F.char_length("b")))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` from ``word`` and ``form``: every round doubles the steps along the chains."""
    current = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("last"))
        moved = written(
            current.join(onward, "root", "left").select("word", F.coalesce("last", "root").alias("root"), F.col("last").isNotNull().alias("moved")),
            "roots",
        )
        current = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return current


def variants(words: DataFrame, ratio: int = RATIO, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of ``words`` (``word``, ``n``)."""
    words = written(words, "words")
    pairs = written(near_pairs(words, least_length), "near_words")
    ways = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n_other")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("n_a"))
    )
    best = ways.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("less"), "other")).alias("best")
    )
    is_form = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    found = written(found, "forms")
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
