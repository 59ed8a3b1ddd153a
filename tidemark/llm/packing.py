"""Best-fit packing of token sequences by bin completion.

Documents become token ids closed by an end id; only one longer than a sequence is cut. Pieces are packed in groups
of some thousand. Within a group the first solution is best fit in decreasing order. If it isn't at the lower bound, a branch
and bound goes over the sequences: the largest piece left opens one, fillings of its room that no other filling
dominates are enumerated best fit first, and a branch ends where the room wasted so far exceeds what a solution better than
the incumbent can waste. Each better solution becomes the incumbent. The search stops at the lower bound or after
a number of steps, so that its time is bounded; a group's sequences that are not nearly full go to a next round
together with those of other groups, until one group is left.

Pieces are spread over groups by row, whatever their ids, so that repeated ids don't meet in one group.

Defined cases: a null or empty text is one piece with the end id alone; ids may be null or repeat, each row is packed by
itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tidemark.llm import spans
from tidemark.llm.tables import written
from tidemark.llm.workers import releasing

GROUP_ROWS = 8192
NEARLY_FULL = 0.98
FILLING_STEPS = 200
FILLINGS = 4
SEARCH_STEPS = 20


@lru_cache(2)
def _encoder(vocabulary: str, end_id: int):
    from tidemark.llm.tokens import WordEncoder

    return WordEncoder(vocabulary, end_id)


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    keep_ids: bool = False,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` of all pieces of all rows."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text())
    narrow = docs.select(docs[ident].alias("doc_id"), docs[text].cast("binary").alias("text"))
    schema = StructType(
        [StructField("doc_id", narrow.schema["doc_id"].dataType), StructField("piece", IntegerType())]
        + [StructField(name, LongType()) for name in ("start", "length", "ids_crc32")]
        + [StructField("ids", ArrayType(IntegerType()))] * keep_ids
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value, end_id)
        for batch in batches:
            for row, data, offsets in spans.blocks(batch.column(1)):
                ids, borders = encoder.encode(data, offsets)
                lengths = np.diff(borders)
                counts = -(-lengths // capacity)
                doc = np.repeat(np.arange(len(lengths)), counts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(capacity, lengths[doc] - start)
                cuts = borders[doc] + start
                parts = [ids[a : a + n] for a, n in zip(cuts.tolist(), length.tolist(), strict=True)]
                crc = [zlib.crc32(part.astype("<u4").tobytes()) for part in parts]
                columns = [batch.column(0).take(pa.array(doc + row)), pa.array(piece, pa.int32())]
                columns += [pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if keep_ids:
                    columns.append(pa.array([part.astype(np.int32) for part in parts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return narrow.mapInArrow(releasing(run), schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Lengths in decreasing order, each into the fullest sequence with room."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, []
    for length in sorted(lengths, reverse=True):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[at].append(length)
        else:
            room, at = capacity, len(bins)
            bins.append([length])
        left = room - length
        by_room[left].append(at)
        rooms |= 1 << left
    return bins


class Stock:
    """Lengths still to be placed, with the nearest one above or below a given length."""

    def __init__(self, lengths: list[int], capacity: int):
        self.counts, self.present = [0] * (capacity + 1), 0
        for length in lengths:
            self.put(length)

    def put(self, length: int) -> None:
        self.counts[length] += 1
        self.present |= 1 << length

    def take(self, length: int) -> None:
        self.counts[length] -= 1
        if not self.counts[length]:
            self.present ^= 1 << length

    def at_most(self, length: int) -> int:
        return (self.present & ((1 << (length + 1)) - 1)).bit_length() - 1

    def above(self, length: int) -> int | None:
        higher = self.present >> (length + 1)
        return length + (higher & -higher).bit_length() if higher else None

    def fillings(self, room: int, most_waste: int) -> list[tuple[int, list[int]]]:
        """Undominated fillings with their waste, best first; enumeration stops at a perfect one or after some steps.

        A filling is dominated if another piece still fits, or if one of its pieces can give way to a larger one.
        """
        found: list[tuple[int, list[int]]] = []
        chosen: list[int] = []
        steps = 0

        def dominated(left: int) -> bool:
            if self.at_most(left) > 0:
                return True
            return any((larger := self.above(one)) is not None and larger - one <= left for one in set(chosen))

        def extend(left: int, top: int) -> bool:
            nonlocal steps
            length = self.at_most(min(left, top))
            if length <= 0:
                if left <= most_waste and (not left or not dominated(left)):
                    found.append((left, list(chosen)))
                return not left
            while length > 0 and steps < FILLING_STEPS:
                steps += 1
                self.take(length)
                chosen.append(length)
                perfect = extend(left - length, length)
                chosen.pop()
                self.put(length)
                if perfect:
                    return True
                length = self.at_most(length - 1)
            return False

        extend(room, room)
        return sorted(found, key=lambda one: one[0])[:FILLINGS]


def complete(lengths: list[int], capacity: int) -> list[list[int]]:
    """Lengths grouped into as few sequences as the bounded search finds."""
    best = best_fit(lengths, capacity)
    total = sum(lengths)
    bound = max(-(-total // capacity), sum(1 for length in lengths if 2 * length > capacity))
    stock, path, open_ = Stock(lengths, capacity), [], []
    steps, wasted = SEARCH_STEPS * len(best), 0
    while len(best) > bound and steps:
        steps -= 1
        allowed = (len(best) - 1) * capacity - total
        if len(path) == len(open_):
            largest = stock.at_most(capacity)
            if largest <= 0:
                best = [list(one) for one, _ in path]
                continue
            stock.take(largest)
            found = stock.fillings(capacity - largest, allowed - wasted) if wasted <= allowed else []
            stock.put(largest)
            open_.append([(waste, [largest, *rest]) for waste, rest in reversed(found)])
        if open_[-1] and open_[-1][-1][0] + wasted <= allowed:
            waste, one = open_[-1].pop()
            for length in one:
                stock.take(length)
            path.append((one, waste))
            wasted += waste
        else:
            open_.pop()
            if not path:
                break
            one, waste = path.pop()
            for length in one:
                stock.put(length)
            wasted -= waste
    return best


def _packer(capacity: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda group: _pack_group(group, capacity, last)


def _pack_group(group: pd.DataFrame, capacity: int, last: bool) -> pd.DataFrame:
    """Rows with ``local`` sequence and ``offset``; ``local`` is -1 for those left to the next round."""
    lengths = group["length"].to_numpy()
    waiting: dict[int, list[int]] = {}
    for row, length in enumerate(lengths.tolist()):
        waiting.setdefault(length, []).append(row)
    local, offset = np.full(len(group), -1), np.zeros(len(group), np.int64)
    number = 0
    for one in complete(lengths.tolist(), capacity):
        if not last and sum(one) < NEARLY_FULL * capacity:
            continue
        at = 0
        for length in one:
            row = waiting[length].pop()
            local[row], offset[row] = number, at
            at += length
        number += 1
    return group.assign(local=local, offset=offset)


def pack(items: DataFrame, capacity: int = 4096, group_rows: int = GROUP_ROWS) -> DataFrame:
    """All rows of ``items`` (with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Rounds are written to the shared folder. A round that leaves over half of its rows is the last but one.
    """
    extra = StructType([StructField(n, LongType()) for n in ("part", "local", "offset")])
    schema = StructType(list(items.schema) + list(extra))
    names = items.columns
    row = F.monotonically_increasing_id()
    results = [
        items.filter(F.col("length") == capacity).select(*names, (-1 - row).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    ]
    left = items.filter(F.col("length") < capacity)
    number, last = 0, False
    count = left.count()
    while count:
        parts = -(-count // group_rows)
        final = last or parts == 1
        spread = left.withColumn("part", F.pmod(F.xxhash64(row), F.lit(parts)))
        packed = spread.groupBy("part").applyInPandas(_packer(capacity, final), schema)
        done = written(packed, f"packed-{number}")
        sequence = F.lit(number << 56) + F.col("part") * (1 << 24) + F.col("local")
        results.append(done.filter("local >= 0").select(*names, sequence.alias("sequence_id"), "offset"))
        left = done.filter("local < 0").select(*names)
        before, count = count, left.count()
        last = 2 * count > before
        number += 1
    whole = results[0]
    for one in results[1:]:
        whole = whole.unionAll(one)
    return whole


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All pieces of all rows with their sequence and place in it."""
    return pack(written(pieces(docs, tokenizer_path, capacity, end_id, False, ident, text), "pieces"), capacity)


def sequences(placed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """``sequence_id`` and its ``ids``, from placed pieces and the same pieces with ids; at most a sequence's ids in one row."""
    keys = ["doc_id", "piece", "ids_crc32"]
    one = with_ids.select(*[F.col(k).alias(f"_{k}") for k in keys], "ids").dropDuplicates([f"_{k}" for k in keys])
    matched = placed.join(one, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return matched.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda part: part["ids"])).alias("ids"))
