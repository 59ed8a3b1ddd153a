"""Near copies by SimHash and exact similarity: texts link where the Jaccard similarity of their sets of word shingles reaches a limit.

Candidates are first of all the pairs whose SimHash fingerprints differ in at most ``LINK_RADIUS`` bits, from ``simhash``'s exact join of fingerprints. At the
limit fingerprints differ in more bits than such a join can cut by, so the rest comes from the sets themselves. Sets that similar share a shingle among the first ``size - ceil(limit * size) + 1`` of either, in whatever order all sets
are put; so texts meet by those shingles and no pair is missed. The order is by hash, with shingles that are frequent in a
bounded sample last, the most frequent ones at the end: it sets how many texts meet, and changes no result.

Where texts meet, pairs are left out whose sizes can't reach the limit or whose SimHash fingerprints of ``2 * 64`` bits differ in over
``RADIUS``; sets at the limit differ in about 20 to 24 bits, so that the radius is over five standard deviations away. All others are
confirmed on their whole sets: first a forest of the pairs at each shingle, then every pair that the confirmed ones don't yet connect and whose
bitmaps leave room for the limit, which is exact and passes few others. So of a group of many copies few pairs are compared on their sets.

Defined cases: a null text is empty; texts without words are equal; shorter ones are one shingle; equal sets are one
class; a null id is never the smallest unless all are null; rows with one id count as one document; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import simhash, spans
from tidemark.llm.components import components
from tidemark.llm.tables import written
from tidemark.llm.workers import releasing

SAMPLE = 20_000
FREQUENT = 20
LINK_RADIUS = 3
RADIUS = 48
PAIR_BLOCK = 1 << 22
BITMAP = 1024
BITMAP_PAIRS = 1 << 16
FIELDS = ["h", "key", "size", "low", "high"]
SCHEMA = "h long, key long, size long, low long, high long"
PAIRS = "a long, b long"


def block_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order per document of a block, the document of each, and where each document begins."""
    folded, starts, ends, shingles = simhash._shingle_borders(data, offsets, words)
    doc = np.repeat(np.arange(len(shingles)), shingles)
    hashes = spans.xxh64(folded, starts, ends)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[new], doc[new]
    return hashes, doc, np.searchsorted(doc, np.arange(len(shingles) + 1))


def set_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit number of every set: the mixed sum of its mixed hashes and its size."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spans.mixed(hashes.copy()))])
    return spans.mixed(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def majorities(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64 bits of every set, each as most of its hashes have it."""
    sizes = np.diff(first)
    result = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, first[some], axis=0, dtype=np.int32)
        most = (2 * counts > sizes[some][:, None]).astype(np.uint8)
        result[some] = np.packbits(most, axis=1, bitorder="little").view("<u8").ravel()
    return result


def prefix_sizes(sizes: np.ndarray, percent: int) -> np.ndarray:
    return np.where(sizes > 0, sizes + (-percent * sizes) // 100 + 1, 0)


def frequent(docs: DataFrame, words: int, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that ``FREQUENT`` texts or more of a sample of about ``SAMPLE`` have, in order, and in how many."""
    count = docs.count()
    bound = min((1 << 63) - 1, -(1 << 63) + (1 << 64) * SAMPLE // max(1, count))
    sampled = docs.select(docs[text].cast("binary").alias("text")).filter(F.xxhash64("text") <= F.lit(bound))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in spans.blocks(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(block_sets(data, offsets, words)[0].view(np.int64))], names=["h"])

    found = sampled.mapInArrow(releasing(run), "h long").groupBy("h").count().filter(F.col("count") >= FREQUENT).toArrow()
    hashes = found.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found.column("count").to_numpy()[order]


def _classes(docs: DataFrame, words: int, ident: str, text: str) -> DataFrame:
    """``doc_id``, ``key`` of its set, its SimHash fingerprint ``fp`` and ``text`` of every row."""
    narrow = docs.select(docs[ident].alias("doc_id"), docs[text].cast("binary").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, prints = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, data, offsets in spans.blocks(batch.column(1)):
                hashes, _, first = block_sets(data, offsets, words)
                keys.append(set_keys(hashes, first))
                prints.append(majorities(hashes, first).view(np.int64))
            columns = [batch.column(0), pa.array(np.concatenate(keys)), pa.array(np.concatenate(prints)), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "fp", "text"])

    return narrow.mapInArrow(releasing(run), f"doc_id {kind}, key long, fp long, text binary")


def fingerprint_pairs(rows: DataFrame, radius: int = LINK_RADIUS) -> DataFrame:
    """``PAIRS`` that connect all sets ``key`` whose fingerprints ``fp`` link within ``radius`` bits; equal fingerprints by their smallest key."""
    sets = rows.select("key", "fp").distinct()
    classes = written(sets.groupBy("fp").agg(F.min("key").alias("least")), "prints")
    one, other = (classes.select(F.col("fp").alias(name), F.col("least").alias(f"key_{name}")) for name in "ab")
    near = simhash.links(classes, radius).join(one, "a").join(other, "b").select("key_a", "key_b")
    equal = sets.join(classes, "fp").filter(F.col("key") != F.col("least")).select("key", "least")
    ends = near.union(equal).toDF("one", "other")
    return ends.select(F.least("one", "other").alias("a"), F.greatest("one", "other").alias("b")).distinct()


def _prefixes(docs: DataFrame, words: int, percent: int, text: str) -> DataFrame:
    """``SCHEMA``: one row per shingle of every text's prefix."""
    often, counts = frequent(docs, words, text)
    shared = docs.sparkSession.sparkContext.broadcast((often, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = shared.value
        for batch in batches:
            for _, data, offsets in spans.blocks(batch.column(0)):
                hashes, doc, first = block_sets(data, offsets, words)
                sizes = np.diff(first)
                columns = [set_keys(hashes, first), sizes]
                columns += [majorities(h, first).view(np.int64) for h in (hashes, spans.mixed(hashes.copy()))]
                if len(often):
                    at = np.minimum(np.searchsorted(often, hashes), len(often) - 1)
                    rank = np.where(often[at] == hashes, counts[at], 0)
                    hashes = hashes[np.lexsort((hashes, rank, doc))]
                own = np.arange(len(hashes)) - first[doc] < prefix_sizes(sizes, percent)[doc]
                rows = [hashes[own].view(np.int64), *(c[doc[own]] for c in columns)]
                yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=FIELDS)

    return docs.select(docs[text].cast("binary").alias("text")).mapInArrow(releasing(run), SCHEMA)


def _runs(rows: DataFrame, use: Callable[[dict, np.ndarray], Iterator[dict]], schema: str) -> DataFrame:
    """``use`` on rows in order of ``h`` with the borders of its runs, none of which is cut."""
    names = rows.columns

    def whole(table: pa.Table, last: bool) -> tuple[dict, np.ndarray, int]:
        columns = {n: _bitmaps(table.column(n)) if n == "bits" else table.column(n).to_numpy() for n in names}
        borders = np.flatnonzero(np.diff(columns["h"])) + 1
        end = table.num_rows if last else int(borders[-1]) if len(borders) else 0
        return {n: c[:end] for n, c in columns.items()}, np.concatenate([[0], borders[borders < end], [end]]), end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            ends = batch.column(0)
            if sum(map(len, held)) < 1 << 17 or ends[0].as_py() == ends[len(batch) - 1].as_py():
                continue
            table = pa.Table.from_batches(held)
            columns, borders, end = whole(table, False)
            yield from map(pa.RecordBatch.from_pydict, use(columns, borders))
            held = table.slice(end).to_batches()
        if held:
            columns, borders, _ = whole(pa.Table.from_batches(held), True)
            yield from map(pa.RecordBatch.from_pydict, use(columns, borders))

    return rows.repartition("h").sortWithinPartitions("h", "key").mapInArrow(releasing(run), schema)


def _near(columns: dict, one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of rows may reach the limit."""
    a, b = columns["size"][one], columns["size"][other]
    bits = sum(np.bitwise_count((columns[n][one] ^ columns[n][other]).view(np.uint64)).astype(np.int64) for n in ("low", "high"))
    return (bits <= RADIUS) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))


def _bitmaps(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _bitmap(hashes: np.ndarray) -> bytes:
    """``BITMAP`` bits, each flipped by every shingle that falls on it: two sets differ in at least as many shingles as their bitmaps in bits."""
    return np.packbits(np.bincount((hashes % np.uint64(BITMAP)).astype(np.int64), minlength=BITMAP) & 1).tobytes()


def _may_reach(columns: dict, one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether the bitmaps of pairs leave room for the limit; no pair that reaches it is left out."""
    keep = np.zeros(len(one), bool)
    for low in range(0, len(one), BITMAP_PAIRS):
        a, b = one[low : low + BITMAP_PAIRS], other[low : low + BITMAP_PAIRS]
        apart = np.bitwise_count(columns["bits"][a] ^ columns["bits"][b]).sum(1, dtype=np.int64)
        keep[low : low + BITMAP_PAIRS] = (100 + percent) * apart <= (100 - percent) * (columns["size"][a] + columns["size"][b])
    return keep


def _met(columns: dict, borders: np.ndarray) -> Iterator[dict]:
    """Rows whose shingle several classes have, each class once."""
    h, key = columns["h"], columns["key"]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
    run = np.repeat(np.arange(len(borders) - 1), np.diff(borders))[new]
    many = np.bincount(run, minlength=1)[run] > 1
    yield {n: pa.array(c[new][many]) for n, c in columns.items()}


def _pairs(a: np.ndarray, b: np.ndarray) -> dict:
    return {"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))}


def _forest(percent: int) -> Callable[[dict, np.ndarray], Iterator[dict]]:
    """A forest of the pairs that may reach the limit, per shingle."""

    def use(columns: dict, borders: np.ndarray) -> Iterator[dict]:
        key, found = columns["key"], []
        starts, sizes = borders[:-1], np.diff(borders)
        two = starts[sizes == 2]
        found.append(np.stack([two, two + 1])[:, _near(columns, two, two + 1, percent)])
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            left, open_ = np.arange(start, start + size), []
            while len(left):
                if not open_:
                    open_, left = [left[0]], left[1:]
                one = open_.pop(0)
                near = _near(columns, np.full(len(left), one), left, percent)
                found.append(np.stack([np.full(near.sum(), one), left[near]]))
                open_ += left[near].tolist()
                left = left[~near]
        a, b = np.concatenate(found, axis=1)
        yield _pairs(key[a], key[b])

    return use


def _apart(percent: int) -> Callable[[dict, np.ndarray], Iterator[dict]]:
    """All pairs that may reach the limit and have different roots, per shingle."""

    def use(columns: dict, borders: np.ndarray) -> Iterator[dict]:
        key, root = columns["key"], columns["root"]
        for start, end in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            if (root[start:end] == root[start]).all():
                continue
            step = max(1, PAIR_BLOCK // (end - start))
            for low in range(start, end, step):
                a, b = np.nonzero(root[low : min(low + step, end), None] != root[None, start:end])
                a, b = a + low, b + start
                a, b = a[a < b], b[a < b]
                near = _near(columns, a, b, percent)
                a, b = a[near], b[near]
                near = _may_reach(columns, a, b, percent)
                if near.any():
                    yield _pairs(key[a[near]], key[b[near]])

    return use


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of ``PAIRS`` whose sets reach the limit."""
    one = sets.select(F.col("key").alias("a"), F.col("hashes").alias("left"))
    other = sets.select(F.col("key").alias("b"), F.col("hashes").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (left, right))
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(releasing(run), PAIRS)


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """``key``, ``hashes`` and ``bits`` of texts that have ``key`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, bits = [], []
            for _, data, offsets in spans.blocks(batch.column(1)):
                hashes, _, first = block_sets(data, offsets, words)
                parts = np.split(hashes, first[1:-1])
                found += [part.astype("<u8").tobytes() for part in parts]
                bits += [_bitmap(part) for part in parts]
            columns = [batch.column(0), pa.array(found, pa.binary()), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "hashes", "bits"])

    return texts.mapInArrow(releasing(run), "key long, hashes binary, bits binary")


def near_copies(
    docs: DataFrame, words: int = 5, percent: int = 80, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row's ``doc_id`` and ``component_id``, the smallest id linked to it; ``percent`` is the least similarity."""
    keyed = _classes(docs, words, ident, text)
    rows = written(keyed.select("doc_id", "key", "fp"), "keys")
    printed = fingerprint_pairs(rows)
    met = written(_runs(_prefixes(docs, words, percent, text), _met, SCHEMA), "met")
    tried = written(printed.union(_runs(met, _forest(percent), PAIRS)).distinct(), "pairs")
    nodes = written(tried.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "nodes")
    texts = keyed.select("key", "text").join(nodes, "key", "left_semi")
    sets = written(_sets(texts.groupBy("key").agg(F.first("text").alias("text")), words), "sets")
    links = written(confirmed(tried, sets, percent), "links")
    roots = components(links).withColumnRenamed("node", "key")
    open_ = met.join(sets.select("key", "bits"), "key").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    others = _runs(open_.select(*FIELDS, "root", "bits"), _apart(percent), PAIRS).distinct().join(tried, ["a", "b"], "left_anti")
    more = written(confirmed(written(others, "pairs"), sets, percent), "links")
    roots = components(links.union(more)).withColumnRenamed("node", "key")
    rooted = rows.select("doc_id", "key").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(smallest, "root").select("doc_id", "component_id")


def survivors(
    docs: DataFrame, words: int = 5, percent: int = 80, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents with the smallest id of their component, with all columns."""
    groups = near_copies(docs, words, percent, ident, text)
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs[ident].eqNullSafe(kept["_kept"]), "left_semi")
