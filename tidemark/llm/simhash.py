"""Near-duplicates by SimHash fingerprints, joined exactly with vantage points.

The fingerprint of a text has a bit set where over half of the hashes of its word shingles have it. Texts link where
fingerprints differ in at most ``radius`` bits.

All links are found among the distinct fingerprints. Each vantage point splits them into a near and a far side at a
distance; a fingerprint on the near side within ``radius`` of the border is also sent to the far side. By the triangle
bound, two linked fingerprints on different sides differ by at most ``radius`` in their distances, so the near one lies
in that strip and both meet on the far side. Every side has a vantage point of its own, and is cut only where that
leaves less to compare than all its pairs; the sides not cut are the shards. The fullest side is cut first, until all are small or
fingerprints are sent ``MAX_COPIES`` times on average. Inside a shard the same splitting goes on, down
to leaves compared all with all in blocks. A shard reports a forest of its links, never all pairs of a group.

Vantage points come from a bounded sample of fingerprints (``SAMPLE``); they set where the work is done and change no result.

Defined cases: a null text is empty; texts without words have fingerprint zero; shorter ones are one shingle; a null id
is never the smallest unless all are null; rows with one id count as one document in ``survivors``; an empty table
gives an empty result; other columns are ignored or, in ``survivors``, kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm import spans
from tidemark.llm.components import components, local_roots
from tidemark.llm.tables import least_hashed, written

SAMPLE = 20_000
SHARD_ROWS = 16_384
LEAST_SHARE = 1 / 256
MAX_COPIES = 16
CANDIDATES = 12
WORK_POWER = 1.5
WORTH = 0.95
LEAF_ROWS = 512


def _shingle_borders(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes with one space after a word, starts and ends of the shingles, and shingles per document."""
    starts, ends = spans.words(data, offsets)
    keep = ~spans.WHITE[data]
    follows = ends[ends < len(data)]
    follows = follows[spans.WHITE[data[follows]]]
    folded = spans.FOLD[data]
    folded[follows] = 32
    keep[follows] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    starts, ends = place[starts], place[ends]
    first = np.searchsorted(starts, place[offsets[:-1]])
    last = np.append(first[1:], len(starts))
    count = last - first
    shingles = np.where(count == 0, 0, np.maximum(count - words + 1, 1))
    doc = np.repeat(np.arange(len(count)), shingles)
    index = first[doc] + np.arange(len(doc)) - (np.cumsum(shingles) - shingles)[doc]
    return folded[keep], starts[index], ends[np.minimum(index + words, last[doc]) - 1], shingles


def block_fingerprints(data: np.ndarray, offsets: np.ndarray, words: int) -> np.ndarray:
    """The fingerprint of every document of a block."""
    folded, starts, ends, shingles = _shingle_borders(data, offsets, words)
    result = np.zeros(len(shingles), np.uint64)
    some = np.flatnonzero(shingles)
    if not len(some):
        return result
    hashes = spans.xxh64(folded, starts, ends)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.add.reduceat(bits, (np.cumsum(shingles) - shingles)[some], axis=0, dtype=np.int64)
    set_ = (2 * counts > shingles[some][:, None]).astype(np.uint8)
    result[some] = np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel()
    return result


def fingerprints(docs: DataFrame, words: int = 3, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, of every row."""
    narrow = docs.select(docs[ident].alias("doc_id"), docs[text].cast("binary").alias("text"))
    schema = StructType([StructField("doc_id", narrow.schema["doc_id"].dataType), StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [block_fingerprints(data, offsets, words) for _, data, offsets in spans.blocks(batch.column(1))]
            found = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return narrow.mapInArrow(run, schema)


def distances(one: np.uint64, many: np.ndarray) -> np.ndarray:
    return np.bitwise_count(many ^ one)


def best_cut(members: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """Vantage point and largest near distance; None if the two sides' pairs are not clearly fewer than the members' own.

    A cut is as good as the work it leaves, which grows with a side's size to a power above one; where
    distances leave a gap, few fingerprints go to both sides.
    """
    best = None
    for point in members[np.linspace(0, len(members) - 1, CANDIDATES).astype(int)]:
        near = np.cumsum(np.bincount(distances(point, members), minlength=65)).astype(float)
        strip = np.concatenate([np.zeros(radius), near[:-radius]]) if radius else near
        far = len(members) - strip
        work = np.where(near**2 + far**2 < WORTH * len(members) ** 2, near**WORK_POWER + far**WORK_POWER, np.inf)
        at = int(np.argmin(work))
        if work[at] < np.inf and (best is None or work[at] < best[2]):
            best = point, at, work[at]
    return best[:2] if best else None


def sides(points: np.ndarray, vantage: np.uint64, border: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether points belong to the near and to the far side."""
    away = distances(vantage, points)
    return away <= border, away > border - radius


def vantage_tree(sample: np.ndarray, share: float, radius: int) -> list[tuple[np.uint64, int, int, int] | None]:
    """Nodes, the root first: vantage point, largest near distance and the nodes of the near and the far side; None for a shard.

    The fullest shard is cut until all hold under ``share`` of the sample, or the shards together ``MAX_COPIES`` times the sample.
    """
    nodes: list[tuple[np.uint64, int, int, int] | None] = [None]
    open_, held = [(-len(sample), 0, sample)], len(sample)
    while open_ and held < MAX_COPIES * len(sample):
        _, node, members = heappop(open_)
        if len(members) <= max(1, share * len(sample)):
            break
        cut = best_cut(members, radius)
        if cut:
            parts = [members[side] for side in sides(members, *cut, radius)]
            nodes[node] = (*cut, len(nodes), len(nodes) + 1)
            for part in parts:
                heappush(open_, (-len(part), len(nodes), part))
                nodes.append(None)
            held += sum(map(len, parts)) - len(members)
    return nodes


def shards_of(points: np.ndarray, nodes: list[tuple[np.uint64, int, int, int] | None], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Shards and the points sent to each."""
    shards, sent, open_ = [np.zeros(0, np.int64)], [points[:0]], [(0, points)]
    while open_:
        node, members = open_.pop()
        if not len(members):
            continue
        if nodes[node] is None:
            shards.append(np.full(len(members), node))
            sent.append(members)
            continue
        vantage, border, *below = nodes[node]
        open_ += [(side, members[own]) for side, own in zip(below, sides(members, vantage, border, radius), strict=True)]
    return np.concatenate(shards), np.concatenate(sent)


def linked_roots(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links among distinct fingerprints: pairs of positions, found by further vantage points."""
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def compare(left: np.ndarray, right: np.ndarray) -> None:
        a, b = np.nonzero(np.bitwise_count(points[left][:, None] ^ points[right][None, :]) <= radius)
        both = np.concatenate([left, right])
        root = local_roots(len(both), a, b + len(left))
        moved = np.flatnonzero(root != np.arange(len(both)))
        found_a.append(both[moved])
        found_b.append(both[root[moved]])

    open_ = [np.arange(len(points))]
    while open_:
        members = open_.pop()
        cut = best_cut(points[members], radius) if len(members) > LEAF_ROWS else None
        if cut:
            open_ += [members[side] for side in sides(points[members], *cut, radius)]
            continue
        parts = [members[i : i + LEAF_ROWS] for i in range(0, len(members), LEAF_ROWS)]
        for i, part in enumerate(parts):
            for other in parts[i:]:
                compare(part, other)
    return np.concatenate(found_a), np.concatenate(found_b)


def links(classes: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints ``fp`` that connect all within ``radius`` bits of each other."""
    count = classes.count()
    share = max(SHARD_ROWS / max(1, count), LEAST_SHARE)
    sampled = least_hashed(classes.select("fp", F.xxhash64("fp").alias("h")), "h", SAMPLE)
    sample = np.array([row.fp for row in sampled.collect()], np.int64).view(np.uint64)
    nodes = vantage_tree(sample, share, radius)

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            shards, points = shards_of(frame["fp"].to_numpy(np.int64).view(np.uint64), nodes, radius)
            yield pd.DataFrame({"shard": shards, "fp": points.view(np.int64)})

    def within(shard: pd.DataFrame) -> pd.DataFrame:
        points = np.sort(shard["fp"].to_numpy(np.int64))
        a, b = linked_roots(points.view(np.uint64), radius)
        root = local_roots(len(points), a, b)
        moved = np.flatnonzero(root != np.arange(len(points)))
        return pd.DataFrame({"a": points[moved], "b": points[root[moved]]})

    routed = classes.select("fp").mapInPandas(route, "shard long, fp long")
    return routed.groupBy("shard").applyInPandas(within, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 2, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row's ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id linked to it."""
    prints = written(fingerprints(docs, words, ident, text), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes, radius)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(members, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def survivors(
    docs: DataFrame, words: int = 3, radius: int = 2, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents with the smallest id of their component, with all columns."""
    groups = near_duplicates(docs, words, radius, ident, text)
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs[ident].eqNullSafe(kept["_kept"]), "left_semi")
