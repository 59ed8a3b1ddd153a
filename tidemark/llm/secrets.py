"""Secret scan: token-like candidates, from which a random forest trained on labelled findings removes the false positives.

A candidate is a maximal run of ASCII letters, digits and ``+/_-`` of at least ``LEAST_LENGTH`` bytes with a digit, in mixed case or without
lower-case letters, or the whole value that follows a name for credentials and ``=`` or ``:``, of any length and characters: up to the
closing quote of its line, else to the next blank, without commas, dots, semicolons and closing brackets at its end. Runs inside such a value are none.
The forest sees its length, how its characters pass between lower case, upper case, digits and signs, how much of it
dictionary words cover, the path of the document, and the words next to it.

Training takes at most ``MAX_FINDINGS`` labelled candidates, half of them of either label, those with the smallest hash of document and place, as
rows of features; each weighs as many as it stands for. Candidates and scores cover all documents.

Defined cases: a null text has no candidates; a null path has no path features; findings with a null label, or that are no candidate, aren't
used; one labelled twice counts twice; without labels of both kinds every score is the share of label 1 (0.0 without any); rows
with one id have their candidates each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StringType, StructField, StructType

from tidemark.llm import spans
from tidemark.llm.tables import least_hashed

LEAST_LENGTH = 12
ASSIGNED = re.compile(
    rb"""(?i:password|passwd|secret|token|api[_-]?key)\s*[=:]\s*(?:"((?:[^"\\\r\n]|\\.)+)"|'((?:[^'\\\r\n]|\\.)+)'|["']?([^\s"']\S*))"""
)
NAMES = (b"passw", b"secret", b"token", b"api")
AFTER_VALUE = b",.;)]}"
MAX_FINDINGS = 20_000
AROUND = 80
PATH_PLACES, WORD_PLACES = 8, 48
LEAST_WORD = 4
TREES, DEPTH, LEAST_LEAF, CUTS = 40, 10, 2, 12

OUTSIDE = np.ones(256, bool)
OUTSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_-"]] = False
DIGIT, LOWER, UPPER = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
DIGIT[48:58] = True
LOWER[97:123] = True
UPPER[65:91] = True
KIND = np.full(256, 3)
KIND[97:123], KIND[65:91], KIND[48:58] = 0, 1, 2


def assigned_values(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the values assigned to names for credentials, none across documents."""
    text, found = data.tobytes(), []
    for first, last in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        low = text[first:last].lower()
        if not any(name in low for name in NAMES):
            continue
        for match in ASSIGNED.finditer(text, first, last):
            start, end = match.span(match.lastindex)
            if match.lastindex == 3:
                end = start + len(match[3].rstrip(AFTER_VALUE).rstrip(b"\"'").rstrip(AFTER_VALUE) or match[3])
            found.append((start, end))
    starts, ends = np.array(found, np.int64).reshape(-1, 2).T
    return starts, ends


def block_candidates(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of all candidates of a block."""
    starts, ends = spans.words(data, offsets, OUTSIDE)
    long_ = ends - starts >= LEAST_LENGTH
    starts, ends = starts[long_], ends[long_]
    digits = np.concatenate([[0], np.cumsum(DIGIT[data])])
    lower = np.concatenate([[0], np.cumsum(LOWER[data])])
    upper = np.concatenate([[0], np.cumsum(UPPER[data])])
    chosen = (digits[ends] > digits[starts]) | (lower[ends] == lower[starts]) | (upper[ends] > upper[starts])
    starts, ends = starts[chosen], ends[chosen]
    values, stops = assigned_values(data, offsets)
    if len(values):
        within = np.searchsorted(values, starts, "right") - 1
        apart = (within < 0) | (starts >= stops[np.maximum(within, 0)])
        starts, ends = np.concatenate([starts[apart], values]), np.concatenate([ends[apart], stops])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


@lru_cache(4)
def longest_word(words: frozenset[str]) -> int:
    return max(map(len, words), default=0)


def coverage(text: str, words: frozenset[str]) -> float:
    """Share of the characters that dictionary words cover, longest words first from the left."""
    low, at, covered = text.lower(), 0, 0
    longest = longest_word(words)
    while at < len(low):
        for size in range(min(longest, len(low) - at), LEAST_WORD - 1, -1):
            if low[at : at + size] in words:
                covered += size
                at += size
                break
        else:
            at += 1
    return covered / max(1, len(low))


def _place(kind: str, word: str, places: int) -> int:
    return zlib.crc32(f"{kind}:{word}".encode()) % places


def features(candidate: bytes, before: bytes, after: bytes, path: str | None, words: frozenset[str]) -> list[float]:
    kinds = KIND[np.frombuffer(candidate, np.uint8)]
    steps = np.bincount(kinds[:-1] * 4 + kinds[1:], minlength=16) / max(1, len(kinds) - 1)
    shares = np.bincount(kinds, minlength=4) / len(kinds)
    letters = np.bincount(np.frombuffer(candidate, np.uint8))
    letters = letters[letters > 0] / len(candidate)
    row = [float(len(candidate)), float(-(letters * np.log2(letters)).sum()), coverage(candidate.decode("utf-8", "replace"), words)]
    row += steps.tolist() + shares.tolist()
    places = [0.0] * PATH_PLACES
    for part in re.findall(r"\w+", (path or "").lower()):
        places[_place("path", part, PATH_PLACES)] = 1.0
    row += places
    near = before.rsplit(b"\n", 1)[-1].decode("utf-8", "replace")
    row += [float(re.search(r"[=:]\s*[\"']?$", near) is not None), float(near.endswith(('"', "'"))), float(after[:1] in (b'"', b"'"))]
    places = [0.0] * WORD_PLACES
    following = after.split(b"\n", 1)[0].decode("utf-8", "replace")
    for side, found in (("before", re.findall(r"\w+", near)[-2:]), ("after", re.findall(r"\w+", following)[:1])):
        for word in found:
            places[_place(side, word.lower(), WORD_PLACES)] = 1.0
    return row + places


@dataclass
class Forest:
    """Trees as arrays of feature, threshold, left and right child and share of label 1; feature -1 is a leaf."""

    trees: list[tuple[np.ndarray, ...]]
    share: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.trees or not len(rows):
            return np.full(len(rows), self.share)
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, threshold, left, right, value in self.trees:
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                inner = feature[node] >= 0
                goes_left = rows[every, np.maximum(feature[node], 0)] <= threshold[node]
                node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
            total += value[node]
        return total / len(self.trees)


def _grow(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, ...]:
    nodes: list[list[float]] = []
    ones = labels * weights

    def split(own: np.ndarray, depth: int) -> int:
        number = len(nodes)
        weight = weights[own].sum()
        share = float(ones[own].sum() / weight)
        nodes.append([-1, 0.0, 0, 0, share])
        if depth == DEPTH or len(own) < 2 * LEAST_LEAF or share in (0.0, 1.0):
            return number
        best = (share * (1 - share) * weight - 1e-9, -1, 0.0)
        for feature in random.choice(rows.shape[1], int(np.sqrt(rows.shape[1])) + 1, replace=False):
            column = rows[own, feature]
            values = np.unique(column)
            middles = (values[1:] + values[:-1]) / 2
            if len(middles) > CUTS:
                middles = middles[np.linspace(0, len(middles) - 1, CUTS).astype(int)]
            for middle in middles:
                low = column <= middle
                count = int(low.sum())
                if min(count, len(own) - count) < LEAST_LEAF:
                    continue
                left, right = weights[own[low]].sum(), weights[own[~low]].sum()
                a, b = ones[own[low]].sum() / left, ones[own[~low]].sum() / right
                impure = a * (1 - a) * left + b * (1 - b) * right
                if impure < best[0]:
                    best = (impure, int(feature), float(middle))
        if best[1] >= 0:
            low = rows[own, best[1]] <= best[2]
            nodes[number][:2] = best[1:]
            nodes[number][2] = split(own[low], depth + 1)
            nodes[number][3] = split(own[~low], depth + 1)
        return number

    split(random.integers(0, len(rows), len(rows)), 0)
    table = np.array(nodes)
    return table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4]


def fit(rows: np.ndarray, labels: np.ndarray, seed: int = 11, weights: np.ndarray | None = None) -> Forest:
    """Train on rows that stand for ``weights`` rows each, 1 by default."""
    weights = np.ones(len(labels)) if weights is None else weights
    share = float(np.average(labels, weights=weights)) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Forest([], share)
    random = np.random.default_rng(seed)
    return Forest([_grow(rows, labels, weights, random) for _ in range(TREES)], share)


def candidates(
    docs: DataFrame, dictionary: Iterable[str], ident: str = "doc_id", text: str = "text", path: str = "source"
) -> DataFrame:
    """Every candidate's ``doc_id``, ``start`` and ``length`` in bytes, ``value``, text ``before`` it on both sides, and ``features``."""
    words = docs.sparkSession.sparkContext.broadcast(frozenset(w.lower() for w in dictionary if len(w) >= LEAST_WORD))
    narrow = docs.select(
        docs[ident].alias("doc_id"), docs[path].cast("string").alias("path"), docs[text].cast("binary").alias("text")
    )
    schema = StructType(
        [StructField("doc_id", narrow.schema["doc_id"].dataType)]
        + [StructField(n, LongType()) for n in ("start", "length")]
        + [StructField(n, StringType()) for n in ("value", "before")]
        + [StructField("features", ArrayType(FloatType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(1)
            for row, data, offsets in spans.blocks(batch.column(2)):
                starts, ends, doc = block_candidates(data, offsets)
                values, befores, found = [], [], []
                for a, b, d in zip(starts.tolist(), ends.tolist(), doc.tolist(), strict=True):
                    before = data[max(offsets[d], a - AROUND) : a].tobytes()
                    after = data[b : min(offsets[d + 1], b + AROUND)].tobytes()
                    value = data[a:b].tobytes()
                    values.append(value.decode("utf-8", "replace"))
                    befores.append(before.decode("utf-8", "ignore"))
                    found.append(features(value, before, after, paths[row + d].as_py(), words.value))
                columns = [batch.column(0).take(pa.array(doc + row)), pa.array(starts - offsets[doc]), pa.array(ends - starts)]
                columns += [pa.array(values, pa.string()), pa.array(befores, pa.string()), pa.array(found, pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return narrow.mapInArrow(run, schema)


def train(found: DataFrame, label: Column) -> Forest:
    """Train on candidates with a label of 0 or 1, a bounded sample of either by hash."""
    labelled = found.select(F.xxhash64("doc_id", "start").alias("h"), label.cast("int").alias("label"), "features")
    counts = dict(labelled.filter(F.col("label").isin(0, 1)).groupBy("label").count().collect())
    sample = []
    for kind in counts:
        sample += least_hashed(labelled.filter(F.col("label") == kind), "h", MAX_FINDINGS // 2).collect()
    sample.sort(key=lambda row: (row.h, row.label, row.features))
    labels = np.array([row.label for row in sample], float)
    weights = np.ones(len(labels))
    for kind, count in counts.items():
        weights[labels == kind] = count / (labels == kind).sum()
    return fit(np.array([row.features for row in sample], np.float32), labels, weights=weights)


def score(found: DataFrame, forest: Forest) -> DataFrame:
    """Candidates with ``value_sha256`` in place of their text, and ``score``."""
    shared = found.sparkSession.sparkContext.broadcast(forest)
    narrow = found.select("doc_id", "start", "length", "value", "features")
    schema = StructType([*narrow.schema.fields[:3], StructField("value_sha256", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                rows = np.array(batch.column(4).to_pylist(), np.float32)
                digests = [hashlib.sha256(value.encode()).hexdigest() for value in batch.column(3).to_pylist()]
                columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(digests), pa.array(shared.value.scores(rows))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return narrow.mapInArrow(run, schema)
