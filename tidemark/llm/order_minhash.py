"""Order MinHash fingerprints, and their comparison with an edited text and with the next document.

A text is its code points. Every window of ``K`` of them is numbered by how many equal windows come before it, and
window and number are hashed together. The hash range is cut into ``SLOTS`` equal parts: in each the ``TUPLE``
windows with the smallest hashes are taken, put back into their order in the text and hashed as a tuple. A moved or edited
passage thus changes the tuples it takes part in, even where the windows themselves stay. A text shorter than a
window is one window. The fingerprint is four hex digits per slot, ``0000`` where no window falls.

Likeness is the share of equal slots among those filled in either text, to the power 1 / ``TUPLE``: a tuple is equal
only if all its windows are, so this estimates the share of windows in common. Two texts without code points have 1.0.

Defined cases: a null text is empty; documents are in ascending order of id, null last, and rows with one id in order of their
texts; after the last comes the first, so that a lone document follows itself; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidemark.llm import spans

K = 8
SLOTS = 128
TUPLE = 2
BLOCK_TEXT = 8 << 20
MAX_BLOCKS = 20_000
BLOCKS_PER_TASK = 4


def _by_hash(hashes: np.ndarray) -> np.ndarray:
    """Positions in ascending order of hash, of equal hashes in order.

    One sort of hash and position in one number; the low bits of the hash that make room for the position don't count.
    """
    bits = np.uint64(max(1, int(len(hashes)).bit_length()))
    order = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    order.sort()
    return (order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def numbered_windows(points: np.ndarray) -> np.ndarray:
    """A hash of every window and of how many equal ones come before it, in text order."""
    width = min(K, len(points))
    windows = spans.window_hashes(points.astype(np.uint64) + np.uint64(1), width) if width else np.zeros(0, np.uint64)
    position = _by_hash(windows)
    value = windows[position]
    index = np.arange(len(value))
    is_first = np.ones(len(value), bool)
    is_first[1:] = value[1:] != value[:-1]
    number = index - np.maximum.accumulate(np.where(is_first, index, 0))
    result = np.empty(len(value), np.uint64)
    result[position] = spans.mixed(value * np.uint64(spans.MULTIPLIER) + number.astype(np.uint64))
    return result


def fingerprint(text: str) -> np.ndarray:
    """One 16-bit value per slot; 0 where the slot has no window."""
    hashes = numbered_windows(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"))
    result = np.zeros(SLOTS, np.uint16)
    if not len(hashes):
        return result
    position = _by_hash(hashes)
    slot = hashes[position] >> np.uint64(64 - SLOTS.bit_length() + 1)
    first = np.searchsorted(slot, np.arange(SLOTS, dtype=np.uint64))
    count = np.minimum(np.diff(np.append(first, len(slot))), TUPLE)
    filled = np.flatnonzero(count)
    taken = np.minimum(first[filled, None] + np.arange(TUPLE), (first + count)[filled, None] - 1)
    place = np.sort(position[taken], axis=1)
    tuples = np.zeros(len(filled), np.uint64)
    for column in range(TUPLE):
        tuples = spans.mixed(tuples * np.uint64(spans.MULTIPLIER) + hashes[place[:, column]])
    result[filled] = tuples % np.uint64(65535) + np.uint64(1)
    return result


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    filled = (one > 0) | (other > 0)
    return float((one == other)[filled].mean() ** (1 / TUPLE)) if filled.any() else 1.0


def as_text(one: np.ndarray) -> str:
    return one.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The later half replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _block_firsts(docs: DataFrame) -> list[int]:
    """Ids that begin the blocks of the ordered documents; there are as many blocks as the texts' size asks for, up to ``MAX_BLOCKS``.

    Blocks are read as streams, so that their size doesn't bound what is held.
    """
    size, least = docs.agg(F.sum(F.octet_length("text")), F.min("doc_id")).first()
    if least is None:
        return []
    blocks = min(MAX_BLOCKS, max(4 * BLOCKS_PER_TASK, -(-(size or 0) // BLOCK_TEXT)))
    shares = [i / blocks for i in range(1, blocks)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * blocks)).first()[0]
    return sorted({least, *found})


def compare_with_next(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its fingerprint, its edited text's, and the likeness to that and to the next document.

    The documents are shuffled once, by block of ids, and stream through in order. The document that begins a block goes
    also to the block before, as its last one's next; the first of all also to the last block.
    """
    rows = docs.select(docs[ident].cast("bigint").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    firsts = np.array(_block_firsts(rows), np.int64)
    last = max(0, len(firsts) - 1)

    @F.pandas_udf("array<struct<block: int, kind: int>>")
    def blocks_of(ids):
        """The document's own block with kind 0, and for one that begins a block also the block before, with kind 1."""
        import pandas as pd

        known = ids.notna().to_numpy()
        values = np.array([int(one) if one is not None else 0 for one in ids], np.int64)
        block = np.where(known, np.searchsorted(firsts, values, "right") - 1, last)
        begins = known & (firsts[block] == values) if len(firsts) else np.ones(len(values), bool)
        before = np.where(block > 0, block - 1, last)
        return pd.Series([
            [(own, 0), (other, 1)] if both else [(own, 0)]
            for own, other, both in zip(block.tolist(), before.tolist(), begins.tolist(), strict=True)
        ])

    # Without any id the order is that of the texts alone, and every row may be the first.
    dealt = rows.withColumn("to", F.explode(blocks_of(F.col("doc_id").cast("string")))).select("to.*", "doc_id", "text")
    partitions = max(1, -(-len(firsts) // BLOCKS_PER_TASK))
    ordered = dealt.repartition(partitions, "block").sortWithinPartitions(
        "block", "kind", F.col("doc_id").asc_nulls_last(), "text"
    )
    schema = StructType(
        [StructField("doc_id", LongType()), StructField("n_chars", LongType())]
        + [StructField(n, StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        + [StructField(n, DoubleType()) for n in ("near_edited", "near_next")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple[int, int | None, str, np.ndarray] | None = None
        for batch in batches:
            out: list[tuple] = []
            for where, kind, id_, body in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                mark = None
                if waiting is not None and waiting[0] == where:
                    mark = fingerprint(body)
                    changed = edited(waiting[2], body)
                    other = fingerprint(changed)
                    out.append((
                        waiting[1], len(waiting[2]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                        as_text(waiting[3]), as_text(other), likeness(waiting[3], other), likeness(waiting[3], mark),
                    ))
                if kind == 1:
                    waiting = None
                else:
                    waiting = (where, id_, body, fingerprint(body) if mark is None else mark)
            columns = list(zip(*out, strict=True)) if out else [[] for _ in schema.names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field_type) for column, field_type in zip(columns, ARROW_TYPES, strict=True)], names=schema.names
            )

    return ordered.mapInArrow(run, schema)


ARROW_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
