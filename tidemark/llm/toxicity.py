"""Toxicity by a small convolutional text classifier, trained in numpy on labelled documents.

A text is its whole sequence of words (runs of ASCII letters and digits and of bytes above 127, A-Z folded). A word and its
first four and six bytes are hashed to numbers; their embedding rows add up to the word's, so that inflected
forms share what their stem has learnt. Filters of several widths slide over the embedded words; the largest
response of each filter over the whole text goes to a logistic output. Numbers seen in fewer than
``MIN_DOCUMENTS`` training texts are blank, so that rare words can't be learnt by heart.

Training takes every labelled row. The numbers' counts are of all trained rows. Rows are dealt by their id into shards of about
``MAX_LABELLED`` rows or ``SHARD_BYTES`` of text; in each of ``ROUNDS`` rounds every shard trains its own copy of the model, and the copies' changes are averaged, those of
an embedding row by how often a shard changed it, as whole multiples of ``1 / UNIT``, so that their order doesn't matter. One row in ``HOLD``, by
its hash, is not trained on: on all of these a threshold is set per language, the one with the best F1 among ``BINS`` levels of score, or the common one where a
language has fewer than ``MIN_POSITIVE`` toxic rows there, which is ``COMMON_THRESHOLD`` where all together have fewer. The score itself sees the text alone.

Defined cases: a null text is an empty one, which is scored like any other; labels that are null, or neither 0 nor 1, or of unknown
documents are not used; a document labelled twice counts twice; without labels of both kinds every score is the share of label 1 (0.0
without any); null languages have the common threshold; an empty table gives an empty result; other
columns are ignored or, in ``accepted``, kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from tidemark.llm import spans
from tidemark.llm.tables import written
from tidemark.llm.workers import release, releasing

NUMBER_BITS = 22
PREFIXES = (None, 4, 6)
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
MAX_LABELLED = 10_000
SHARD_BYTES = 32 << 20
ROUNDS = 3
UNIT = 1 << 24
HOLD = 5
BINS = 1 << 16
MIN_DOCUMENTS = 3
MIN_POSITIVE = 20
EPOCHS = 6
MIN_STEPS = 400
BATCH = 32
RATE = 0.01
DECAY = 1e-3
WORD_DROPOUT = 0.2
COMMON_THRESHOLD = 0.3
BLANK = 0

SEPARATOR = np.ones(256, bool)
SEPARATOR[128:] = False
SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def block_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words of a block (one column per part) and where each document begins; it has one word at least."""
    starts, ends = spans.words(data, offsets, SEPARATOR)
    sums = spans.prefix_sums(spans.byte_values()[spans.FOLD[data]])
    columns = []
    for length in PREFIXES:
        stop = ends if length is None else np.minimum(starts + length, ends)
        hashes = spans.span_hashes(sums, starts, stop) >> np.uint64(64 - NUMBER_BITS)
        if length is not None:
            hashes[ends - starts <= length] = BLANK
        columns.append(hashes.astype(np.int32))
    numbers = np.stack(columns, 1)
    first = np.searchsorted(starts, offsets[:-1])
    empty = np.flatnonzero(np.append(first[1:], len(starts)) == first)
    return np.insert(numbers, first[empty], BLANK, axis=0), first + np.searchsorted(empty, np.arange(len(first)))


@dataclass
class Model:
    """Known numbers in order, their embedding rows after a blank row, weights, and thresholds by language and in common."""

    known: np.ndarray
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float]
    common: float

    def rows(self) -> np.ndarray:
        """The embedding row of every number; 0 where it isn't known."""
        table = np.zeros(1 << NUMBER_BITS, np.int32)
        table[self.known] = np.arange(1, len(self.known) + 1)
        return table

    def scores(self, numbers: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if not len(first):
            return np.zeros(0)
        parts = [self.embedding[rows[numbers[:, i]]] for i in range(len(PREFIXES))]
        vectors = np.sum(parts, axis=0)
        pooled = [np.maximum.reduceat(responses(vectors, self.filters[w], first), first, axis=0) for w in WIDTHS]
        logit = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(logit.astype(float), -30, 30)))


def responses(vectors: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Responses of the filters of one width at every word; windows end with their document, as if blanks followed."""
    result = vectors @ weights[0]
    for j in range(1, len(weights)):
        if len(vectors) > j:
            following = vectors[j:] @ weights[j]
            ended = (first[1:, None] - 1 - np.arange(j)).ravel()
            following[ended[(ended >= 0) & (ended < len(following))]] = 0
            result[: len(following)] += following
    return result


class Adam:
    """First and second moments of one weight array."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.steps = weights, 0
        self.mean, self.square = np.zeros_like(weights), np.zeros_like(weights)

    def step(self, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        self.steps += 1
        self.mean[rows] = 0.9 * self.mean[rows] + 0.1 * gradient
        self.square[rows] = 0.99 * self.square[rows] + 0.01 * gradient**2
        mean = self.mean[rows] / (1 - 0.9**self.steps)
        square = self.square[rows] / (1 - 0.99**self.steps)
        self.weights[rows] -= RATE * mean / (np.sqrt(square) + 1e-6)


def start(known: np.ndarray, seen: np.ndarray, toxic: np.ndarray, share: float, seed: int = 7) -> Model:
    """The untrained model of known numbers, given in how many texts and in how many toxic ones each is.

    The first dimension of an embedding row starts as how far the number's toxic texts exceed their expected count.
    """
    random = np.random.default_rng(seed)
    embedding = random.normal(0, 0.1, (len(known) + 1, DIMENSIONS)).astype(np.float32)
    expected = seen * share
    embedding[1:, 0] = np.clip((toxic - expected) / np.sqrt(expected + 0.5), -2, 8) / 4
    embedding[0] = 0
    filters = {w: random.normal(0, 0.2, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][0, 0] += 0.5
    bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
    out = np.abs(random.normal(0, 0.2, FILTERS * len(WIDTHS))).astype(np.float32)
    if not 0 < share < 1:
        out[:] = 0
    out_bias = float(np.float32(np.log(max(share, 1e-13) / max(1 - share, 1e-13))))
    return Model(known, embedding, filters, bias, out, out_bias, {}, COMMON_THRESHOLD)


def dense(model: Model) -> np.ndarray:
    """All weights but the embedding as one array of rows as wide as the embedding's."""
    flat = np.concatenate([*(model.filters[w].ravel() for w in WIDTHS), model.bias, model.out, [model.out_bias]])
    return np.pad(flat, (0, -len(flat) % DIMENSIONS)).reshape(-1, DIMENSIONS)


def set_dense(model: Model, rows: np.ndarray) -> None:
    flat, at = rows.ravel().astype(np.float32), 0
    for array in (*(model.filters[w] for w in WIDTHS), model.bias, model.out):
        array[...] = flat[at : at + array.size].reshape(array.shape)
        at += array.size
    model.out_bias = float(flat[at])


def improve(model: Model, texts: list[np.ndarray], labels: np.ndarray, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Train the model on one round's share of passes over rows of embedding rows; in how many steps each embedding row changed, if ever, and which.

    Only the window that a filter answers to most carries its gradient.
    """
    random = np.random.default_rng(seed)
    embedding, filters, bias, out, out_bias = model.embedding, model.filters, model.bias, model.out, np.array([model.out_bias], np.float32)
    changed = np.zeros(len(embedding), np.int64)
    adam = {"embedding": Adam(embedding), "bias": Adam(bias), "out": Adam(out), "out_bias": Adam(out_bias)}
    adam |= {w: Adam(filters[w]) for w in WIDTHS}
    passes = max(EPOCHS, -(-MIN_STEPS * BATCH // len(texts)))
    for _ in range(-(-passes // ROUNDS)):
        for chosen in np.array_split(random.permutation(len(texts)), max(1, len(texts) // BATCH)):
            rows = [texts[i] for i in chosen]
            lengths = np.array([len(row) for row in rows])
            ends = np.cumsum(lengths)
            first = ends - lengths
            numbers = np.concatenate(rows)
            numbers[random.random(len(numbers)) < WORD_DROPOUT] = 0
            vectors = embedding[numbers].sum(axis=1)
            best, pooled = [], []
            for w in WIDTHS:
                answer = responses(vectors, filters[w], first)
                at = np.stack([a + answer[a:b].argmax(0) for a, b in zip(first, ends, strict=True)])
                best.append(at)
                pooled.append(np.take_along_axis(answer, at, 0))
            hidden = np.concatenate(pooled, 1) + bias
            active = np.maximum(hidden, 0)
            wrong = (1 / (1 + np.exp(-np.clip(active @ out + out_bias, -30, 30))) - labels[chosen]) / len(chosen)
            back = np.where(hidden > 0, wrong[:, None] * out, 0).astype(np.float32)
            touched, gradients = [], []
            for k, w in enumerate(WIDTHS):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                gradient = np.zeros_like(filters[w])
                for j in range(w):
                    place = best[k] + j
                    inside = place < ends[:, None]
                    place = np.where(inside, place, 0)
                    here = np.where(inside, part, 0)
                    gradient[j] = np.einsum("bf,bfd->df", here, vectors[place])
                    pulled = (here[:, :, None] * filters[w][j].T[None]).reshape(-1, DIMENSIONS)
                    for i in range(len(PREFIXES)):
                        touched.append(numbers[place, i].ravel())
                        gradients.append(pulled)
                adam[w].step(gradient + DECAY * filters[w])
            words, index = np.unique(np.concatenate(touched), return_inverse=True)
            summed = np.zeros((len(words), DIMENSIONS), np.float32)
            np.add.at(summed, index, np.concatenate(gradients))
            summed[words == 0] = 0
            adam["embedding"].step(summed, words)
            changed[words[words > 0]] += 1
            adam["out"].step(active.T @ wrong + DECAY * out)
            adam["bias"].step(back.sum(0))
            adam["out_bias"].step(np.array([wrong.sum()], np.float32))
    model.out_bias = float(out_bias[0])
    places = np.flatnonzero(changed)
    return changed[places], places


def best_threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The middle of the widest gap between scores that gives the best F1 of the weighted rows."""
    weights = np.ones(len(labels)) if weights is None else weights.astype(float)
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum((labels * weights)[order])
    f1 = 2 * hits / (np.cumsum(weights[order]) + (labels * weights).sum())
    level = scores[order]
    below = np.append(level[1:], 0.0)
    f1[level == below] = -1
    tops = np.flatnonzero(f1 >= f1.max() - 1e-12)
    at = tops[np.argmax(level[tops] - below[tops])]
    return float((level[at] + below[at]) / 2)


def calibrate(model: Model, scored: pa.Table) -> None:
    """Set the thresholds from rows that the model wasn't trained on: how many ``rows`` have each ``lang``, ``label`` and ``level`` of score."""
    scores = (scored["level"].to_numpy() + 0.5) / BINS
    labels, rows = scored["label"].to_numpy().astype(float), scored["rows"].to_numpy().astype(float)
    langs = np.array(scored["lang"].to_pylist(), object)

    def threshold(own: np.ndarray) -> float | None:
        toxic = (labels * rows)[own].sum()
        return best_threshold(scores[own], labels[own], rows[own]) if MIN_POSITIVE <= toxic < rows[own].sum() else None

    common = threshold(np.ones(len(rows), bool))
    if common is None:
        return
    model.common = common
    found = {lang: threshold(langs == lang) for lang in sorted({lang for lang in langs if lang is not None})}
    model.thresholds.update({lang: limit for lang, limit in found.items() if limit is not None})


NUMBERED = "h long, label int, lang string, words int, numbers binary"


def _numbered(rows: DataFrame) -> DataFrame:
    """``NUMBERED``: the word numbers of every row of ``h, label, lang, text``, compressed column by column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            found, words = [], []
            for _, data, offsets in spans.blocks(batch.column(3)):
                numbers, first = block_numbers(data, offsets)
                for part in np.split(numbers, first[1:]):
                    words.append(len(part))
                    found.append(codec.compress(np.ascontiguousarray(part.T, "<i4").tobytes(), asbytes=True))
            columns = [*batch.columns[:3], pa.array(words, pa.int32()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "label", "lang", "words", "numbers"])

    return rows.mapInArrow(releasing(run), NUMBERED)


def _texts(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The rows of word numbers of a batch of ``NUMBERED``."""
    codec, parts = pa.Codec("zstd"), len(PREFIXES)
    sizes = batch.column("words").to_pylist()
    raw = [codec.decompress(one.as_buffer(), 4 * parts * size, asbytes=True) for one, size in zip(batch.column("numbers"), sizes, strict=True)]
    return [np.frombuffer(one, "<i4").reshape(parts, -1).T for one in raw]


def _counted(rows: DataFrame) -> pa.Table:
    """Numbers with how many rows and how many toxic rows have them, of those that ``MIN_DOCUMENTS`` rows have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, toxic = (np.zeros(1 << NUMBER_BITS, np.int32) for _ in range(2))
        for batch in batches:
            for text, label in zip(_texts(batch), batch.column("label").to_pylist(), strict=True):
                own = np.unique(text)
                seen[own] += 1
                toxic[own] += label
        seen[BLANK] = 0
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (some, seen[some], toxic[some])], names=["number", "seen", "toxic"])

    counts = rows.mapInArrow(releasing(run), "number long, seen long, toxic long").groupBy("number")
    return counts.agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic")).filter(F.col("seen") >= MIN_DOCUMENTS).toArrow()


def _round(rows: DataFrame, model: Model, number: int) -> None:
    """Train the model a round further on all shards."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = ["place", "steps", *(f"d{i}" for i in range(DIMENSIONS))]

    def shard_changes(shard: int, texts: list[np.ndarray], labels: list[int]) -> pa.RecordBatch:
        whole = shared.value
        rows_of = whole.rows()
        texts = [rows_of[text] for text in texts]
        del rows_of
        # Only the embedding rows of the shard's own numbers are copied.
        own = np.unique(np.concatenate([np.zeros(1, np.int32), *(np.unique(text) for text in texts)]))
        texts = [np.searchsorted(own, text).astype(np.int32) for text in texts]
        before = whole.embedding[own]
        filters = {w: whole.filters[w].copy() for w in WIDTHS}
        local = Model(own, before.copy(), filters, whole.bias.copy(), whole.out.copy(), whole.out_bias, {}, whole.common)
        steps, places = improve(local, texts, np.array(labels, np.float32), [number, shard])
        weights = dense(local) - dense(whole)
        change = np.concatenate([local.embedding[places] - before[places], weights]).astype(float)
        steps = np.concatenate([steps, np.full(len(weights), len(texts))])
        place = np.concatenate([own[places], len(whole.embedding) + np.arange(len(weights))]).astype(np.int64)
        change = np.rint(change * UNIT).astype(np.int64) * steps[:, None]
        return pa.RecordBatch.from_arrays([pa.array(place), pa.array(steps), *(pa.array(c) for c in change.T)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, texts, labels = None, [], []
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            borders = np.concatenate([[0], np.flatnonzero(np.diff(shards)) + 1, [len(shards)]])
            for low, high in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
                if low == high:
                    continue
                if texts and shard != shards[low]:
                    yield shard_changes(shard, texts, labels)
                    texts, labels = [], []
                part = batch.slice(low, high - low)
                shard = int(shards[low])
                texts += _texts(part)
                labels += part.column("label").to_pylist()
        if texts:
            yield shard_changes(shard, texts, labels)

    changes = rows.mapInArrow(releasing(run), ", ".join(f"{name} long" for name in names))
    found = changes.groupBy("place").agg(*[F.sum(name).alias(name) for name in names[1:]]).toArrow()
    shared.unpersist()
    place, steps = found["place"].to_numpy(), found["steps"].to_numpy().astype(float)
    change = np.stack([found[name].to_numpy().astype(float) for name in names[2:]], 1) / UNIT / steps[:, None]
    inner = place < len(model.embedding)
    model.embedding[place[inner]] += change[inner].astype(np.float32)
    weights = dense(model).astype(float)
    weights[place[~inner] - len(model.embedding)] += change[~inner]
    set_dense(model, weights)


def _scored(rows: DataFrame, model: Model) -> pa.Table:
    """How many rows have each ``lang``, ``label`` and ``level`` of score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = shared.value.rows()
        for batch in batches:
            texts = _texts(batch)
            first = np.cumsum([0, *map(len, texts)])[:-1]
            scores = shared.value.scores(np.concatenate(texts), first, rows_of) if texts else np.zeros(0)
            level = np.minimum((scores * BINS).astype(np.int64), BINS - 1)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("label"), pa.array(level)], names=["lang", "label", "level"])

    found = rows.mapInArrow(releasing(run), "lang string, label int, level long").groupBy("lang", "label", "level")
    return found.agg(F.count(F.lit(1)).alias("rows")).orderBy("lang", "level", "label").toArrow()


def train(
    docs: DataFrame,
    labels: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label: str = "toxic",
) -> Model:
    """Train and calibrate on all labelled rows.

    Their word numbers are written once, dealt by shards. A shard lies in one file, in order, so that every round reads it whole in one task; what
    comes back to the driver are counts and changes per number, of which there are at most ``2**NUMBER_BITS``, and rows per level of score.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(ident).isNotNull()).select(
        F.col(ident).alias("_id"), F.col(label).cast("int").alias("label")
    )
    narrow = docs.select(
        docs[ident].alias("_own"), docs[lang].cast("string").alias("lang"), docs[text].cast("binary").alias("text")
    )
    same = F.col("_own") == F.col("_id")
    sizes = narrow.select("_own", F.octet_length("text").alias("size")).join(known, same)
    count, size, toxic = sizes.agg(F.count(F.lit(1)), F.sum("size"), F.sum("label")).first()
    shards = max(1, -(-count // MAX_LABELLED), -(-(size or 0) // SHARD_BYTES))
    # Both sides are dealt by id, so that texts move once, for the join and the shards.
    rows = narrow.repartition(shards, "_own").join(known.repartition(shards, "_id"), same)
    numbered = _numbered(rows.select(F.xxhash64("_id").alias("h"), "label", "lang", "text"))
    placed = numbered.withColumns({"shard": F.spark_partition_id(), "held": F.pmod("h", F.lit(HOLD)) == 0})
    dealt = written(placed.sortWithinPartitions("h", "label", "numbers"), "labelled")
    trained = dealt.filter(~F.col("held"))
    share = float(toxic or 0) / max(1, count)
    counts = _counted(trained).sort_by("number")
    columns = [counts[name].to_numpy().astype(kind) for name, kind in (("number", np.int32), ("seen", np.float32), ("toxic", np.float32))]
    model = start(*columns, share)
    if not 0 < share < 1:
        return model
    for number in range(ROUNDS):
        _round(trained, model, number)
    calibrate(model, _scored(dealt.filter("held"), model))
    return model


def score(docs: DataFrame, model: Model, ident: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id``, ``score`` and ``threshold`` (of the document's language) of every row."""
    narrow = docs.select(
        docs[ident].alias("doc_id"), docs[lang].cast("string").alias("lang"), docs[text].cast("binary").alias("text")
    )
    schema = StructType(
        [StructField("doc_id", narrow.schema["doc_id"].dataType)]
        + [StructField(name, DoubleType()) for name in ("score", "threshold")]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = shared.value.rows()
        for batch in batches:
            parts = [
                shared.value.scores(*block_numbers(data, offsets), rows_of)
                for _, data, offsets in spans.blocks(batch.column(2))
            ]
            scores = np.concatenate(parts).astype(float) if parts else np.zeros(0)
            limits = [shared.value.thresholds.get(x, shared.value.common) for x in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(scores), pa.array(limits, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return narrow.mapInArrow(releasing(run), schema)


def accepted(docs: DataFrame, model: Model, ident: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that score below their language's threshold, with all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def below(texts: pa.Array, langs: pa.Array) -> pa.Array:
        rows_of = shared.value.rows()
        parts = [shared.value.scores(*block_numbers(data, offsets), rows_of) for _, data, offsets in spans.blocks(texts)]
        limits = np.array([shared.value.thresholds.get(x, shared.value.common) for x in langs.to_pylist()], float)
        result = pa.array(np.concatenate([*parts, np.zeros(0)]) < limits)
        del parts, limits
        release()
        return result

    # Only text and language go to the Python worker and one boolean comes back; the rows stay where they are.
    keep = F.arrow_udf(below, BooleanType())
    return docs.filter(keep(docs[text].cast("binary"), docs[lang].cast("string")))


def held_out(ident: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(ident.cast("string").cast("binary")) % 4 == 2
