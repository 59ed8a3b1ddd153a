"""Cross-tokenizer alignment: groups of tokens of two vocabularies between shared cuts, and how usual each link is.

Both vocabularies encode the same bytes; an offset where a token of both ends is a shared cut. ``align`` divides and conquers: in an interval it looks for the
common end nearest to the middle token, by bisect in the other vocabulary's ends, and goes on with both halves; an interval without a cut inside is
a leaf, a group. Tokens of a group whose byte ranges overlap are linked.

Neither vocabulary joins across a border between other characters and white space that begins with a blank, tab or line feed, so such
borders are cuts known beforehand: texts are encoded and aligned by the units between them, each distinct unit of a block once, many units in a row. Units
of up to ``CACHED_CHARACTERS`` that occur again are kept for the next blocks of a task, the less used ones let go. If the pieces of a vocabulary do cross such
borders (``crossing``), whole texts are the units.

Documents form blocks of about ``BLOCK_CHARACTERS``, one row each: what is said per document, the block's distinct id pairs with the number of documents
that hold them, and each document's pairs with their number of links. Counts over the corpus are sums over blocks; every block gets
the counts of its own pairs back. Only pairs of blocks are shuffled, never those of documents, and nothing is broadcast.

An executor's memory does not grow with the table: texts come in batches of ``BATCH_BYTES``, pairs of documents are counted ``PAIRED_UNITS`` units at a time, a block's
documents pass the JVM as one compressed value, and workers, which stay while later stages run, keep only the vocabularies after a task and not even these
where counts are told.

Defined cases: null and empty texts, and texts whose pieces don't give their bytes back in either vocabulary (characters that are no text in
one of them), have no tokens: zeros and an empty ``groups_sha256``; strings of special tokens are plain text; rows with one id or none are documents of their
own, and count as such; a very long text is a block of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from tidemark.llm.tables import written
from tidemark.llm.workers import release, releasing

UNITS = re.compile(r"\s*\S+(?:[^\S \n\t]\s*\S*)*|\s+")
BLOCK_CHARACTERS = 4_000_000
BATCH_UNITS = 4096
CACHED_UNITS = 150_000
CACHED_CHARACTERS = 48
LONG_UNIT = 1000
BATCH_BYTES = 4 << 20
PAIRED_UNITS = 1 << 16
MAX_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Fixed value: the pattern by which byte-level vocabularies cut texts.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SIGNS = b",|;\n"
COMMA, BAR, SEMICOLON, END = range(4)

_BLOCK = "block bigint, pair array<bigint>, holders array<int>, documents binary"
#: Of a block's documents, an Arrow stream with one row: no other reader than this module's needs the values.
_DOCUMENTS = (
    "doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, sha256 array<string>,"
    " ends array<bigint>, place array<int>, links array<int>"
)
_RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def align(a_ends: np.ndarray, b_ends: np.ndarray, a_stops: np.ndarray, b_stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of a and of b are passed at the end of every group, for many texts at once.

    The texts stand in a row: ends are offsets in all of them, ``a_stops`` and ``b_stops`` tell the tokens passed at the end of each. All open
    intervals are halved together, and each looks on both sides of its middle, a token farther in every step.
    """
    a_from, a_to = np.concatenate([[0], a_stops[:-1]]), a_stops
    b_from, b_to = np.concatenate([[0], b_stops[:-1]]), b_stops
    closed = []
    while len(a_to):
        cut_a, cut_b = np.full(len(a_to), -1), np.full(len(a_to), -1)
        looking = np.flatnonzero((a_to - a_from > 1) & (b_to - b_from > 1))
        step = 0
        while len(looking):
            first, last = a_from[looking], a_to[looking] - 1
            at = (first + last) // 2 + ((step + 1) // 2 if step % 2 else -(step // 2))
            inside = (at >= first) & (at < last)
            end = a_ends[np.where(inside, at, first)]
            place = np.searchsorted(b_ends, end)
            hit = inside & (b_ends[place] == end)
            cut_a[looking[hit]], cut_b[looking[hit]] = at[hit] + 1, place[hit] + 1
            looking = looking[~hit & (last - first > step)]
            step += 1
        leaf = cut_a < 0
        closed.append(np.stack([a_to[leaf], b_to[leaf]]))
        halves = ~leaf
        a_from, a_to = np.concatenate([a_from[halves], cut_a[halves]]), np.concatenate([cut_a[halves], a_to[halves]])
        b_from, b_to = np.concatenate([b_from[halves], cut_b[halves]]), np.concatenate([cut_b[halves], b_to[halves]])
    a_groups, b_groups = np.sort(np.concatenate(closed, axis=1) if closed else np.zeros((2, 0), np.int64), axis=1)
    return a_groups, b_groups


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of tokens whose byte ranges overlap, in order, and where each overlap ends: every piece between two ends is one."""
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends), ends


@lru_cache(1)
def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


def merger(byte_vocabulary: str) -> tiktoken.Encoding | None:
    """The vocabulary for the quicker library, where merging by rank is merging by id and the text is cut by the byte-level pattern."""
    parsed = json.loads(byte_vocabulary)
    entries, cutter = parsed["model"]["vocab"], parsed["pre_tokenizer"] or {}
    merges = [pair if isinstance(pair, str) else " ".join(pair) for pair in parsed["model"]["merges"]]
    by_id = [entries.get(pair.replace(" ", "")) for pair in merges] == list(range(256, 256 + len(merges)))
    plain = parsed["normalizer"] is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
    if not (by_id and plain):
        return None
    known = byte_characters()
    ranks = {bytes(known[c] for c in entry): i for entry, i in entries.items() if all(c in known for c in entry)}
    return tiktoken.Encoding("pairs", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})


def byte_tokens(tokenizer: Tokenizer) -> dict[int, bytes]:
    known = byte_characters()
    return {i: bytes(known[c] for c in entry) for entry, i in tokenizer.get_vocab(with_added_tokens=False).items()}


def piece_tokens(processor: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    return [
        bytes([int(processor.id_to_piece(i)[3:5], 16)]) if processor.is_byte(i) else processor.id_to_piece(i).replace("▁", " ").encode()
        for i in range(processor.get_piece_size())
    ]


#: Of one unit: tokens of a, tokens of b, groups and id pairs as 32-bit numbers, its id pairs as 64-bit numbers, and its groups as text.
Unit = bytes
HEAD = 16
NO_UNIT = Unit(HEAD)


def heads(units: list[Unit]) -> np.ndarray:
    """Tokens of a, tokens of b, groups and id pairs of every unit, a row each; a unit without tokens is not valid."""
    return np.frombuffer(b"".join([unit[:HEAD] for unit in units]), np.int32).reshape(-1, 4).astype(np.int64)


class PairEncoder:
    """Units of texts in both vocabularies, kept for the next blocks until they are forgotten."""

    def __init__(self, byte_vocabulary: str, piece_model: bytes):
        self.a = Tokenizer.from_str(byte_vocabulary)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.a_bytes, self.b_bytes = byte_tokens(self.a), piece_tokens(self.b)
        self.blank = self.b.piece_to_id("▁")
        self.merger = merger(byte_vocabulary)
        self.crossing = any(re.search(rb"[^ ] |[\n\t]", one) for i, one in enumerate(self.b_bytes) if not self.b.is_byte(i))
        self.a_sizes = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)])
        self.b_sizes = np.array([len(one) for one in self.b_bytes])
        self.shown = [b"%d%c" % (i, sign) for size in (len(self.a_sizes), len(self.b_sizes)) for i in range(size) for sign in SIGNS]
        self.forget()

    def forget(self) -> None:
        self.recent: dict[str, Unit] = {}
        self.former: dict[str, Unit] = {}

    def units(self, text: str) -> list[str]:
        return [" " + text] if self.crossing else UNITS.findall(" " + text)

    def _a_ids(self, text: str, units: int) -> list[int]:
        """The merger's work on one word grows with the square of its length, so long units alone go to the tokenizer."""
        if self.merger and (units > 1 or len(text) <= LONG_UNIT):
            return self.merger.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def _b_ids(self, text: str) -> list[int] | None:
        """The vocabulary puts a blank before what it encodes: the text's own first blank, or else one that is taken off again."""
        if text == " ":
            return [self.blank]
        ids = self.b.encode(text.removeprefix(" "))
        if text[0] == " ":
            return ids
        return ids[1:] if ids[:1] == [self.blank] else None

    def encode(self, units: list[str]) -> list[Unit]:
        """Units in a row, each ending in no white space or alone; those that don't give their bytes back are found by halving."""
        text = "".join(units)
        raw = text.encode()
        a, b = self._a_ids(text, len(units)), self._b_ids(text)
        if b is not None and b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b)):
            ends = np.cumsum([len(unit.encode()) for unit in units])
            return self._aligned(np.array(a, np.int64), np.array(b, np.int64), ends)
        if len(units) == 1:
            return [NO_UNIT]
        half = len(units) // 2
        return self.encode(units[:half]) + self.encode(units[half:])

    def _aligned(self, a: np.ndarray, b: np.ndarray, unit_ends: np.ndarray) -> list[Unit]:
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_stops, b_stops = np.searchsorted(a_ends, unit_ends) + 1, np.searchsorted(b_ends, unit_ends) + 1
        a_groups, b_groups = align(a_ends, b_ends, a_stops, b_stops)
        group_stops = np.searchsorted(a_groups, a_stops, "right")
        # A group's ids of a stand before its ids of b; the sign after an id tells what follows.
        a_at, b_at = np.arange(len(a)), np.arange(len(b))
        a_group, b_group = np.searchsorted(a_groups, a_at, "right"), np.searchsorted(b_groups, b_at, "right")
        last_of_unit = np.zeros(len(a_groups), bool)
        last_of_unit[group_stops - 1] = True
        a_sign = np.where(a_at + 1 == a_groups[a_group], BAR, COMMA)
        b_sign = np.where(b_at + 1 == b_groups[b_group], np.where(last_of_unit, END, SEMICOLON)[b_group], COMMA)
        shown = np.empty(len(a) + len(b), np.int64)
        shown[a_at + np.concatenate([[0], b_groups])[a_group]] = a * len(SIGNS) + a_sign
        shown[b_at + a_groups[b_group]] = (b + len(self.a_sizes)) * len(SIGNS) + b_sign
        texts = b"".join(map(self.shown.__getitem__, shown.tolist())).split(b"\n")
        a_of, b_of, ends = links(a_ends, b_ends)
        pairs = ((a[a_of] << 32) | b[b_of]).tobytes()
        pair_stops = np.searchsorted(ends, unit_ends, "right")
        cuts = [0, *(8 * pair_stops).tolist()]
        counts = [np.diff(stops, prepend=0) for stops in (a_stops, b_stops, group_stops, pair_stops)]
        head = np.stack(counts, axis=1).astype(np.int32).tobytes()
        return [
            head[at : at + HEAD] + pairs[low:high] + text
            for at, text, low, high in zip(range(0, len(head), HEAD), texts[:-1], cuts[:-1], cuts[1:], strict=True)
        ]

    def known(self, units: list[str], times: np.ndarray) -> list[Unit]:
        """What is known of the units, which occur so many times in their block; the others are encoded, and kept if they occur again."""
        recent, former = self.recent, self.former
        found = [recent.get(unit) or former.get(unit) for unit in units]
        missing = [i for i, one in enumerate(found) if one is None]
        keep = times > 1
        keep[[i for i, one in enumerate(found) if one is not None]] = True
        alone = [i for i in missing if units[i][-1].isspace() or len(units[i]) > LONG_UNIT]
        single = set(alone)
        joined = [i for i in missing if i not in single]
        batches = [[i] for i in alone] + [joined[first : first + BATCH_UNITS] for first in range(0, len(joined), BATCH_UNITS)]
        for batch in batches:
            for i, unit in zip(batch, self.encode([units[i] for i in batch]), strict=True):
                found[i] = unit
        for unit, one, again in zip(units, found, keep.tolist(), strict=True):
            if again and len(unit) <= CACHED_CHARACTERS:
                recent[unit] = one
        if len(recent) > CACHED_UNITS:
            self.recent, self.former = {}, recent
        return found


@lru_cache(1)
def worker_encoder(byte_vocabulary: str, piece_model: bytes) -> PairEncoder:
    """One for all tasks that a worker runs, so that they share the vocabularies."""
    return PairEncoder(byte_vocabulary, piece_model)


def _document_pairs(flat: np.ndarray, stops: np.ndarray, many: np.ndarray, pair_of: np.ndarray, pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document's distinct pairs, in order: the document, the pair's place and its number of links.

    ``flat`` has the documents' units in a row and ``stops`` where each document's end; ``many`` tells of every unit its pairs, which stand in a row in ``pair_of``.
    """
    before = np.cumsum(many) - many
    found = [(np.zeros(0, np.int32),) * 3]
    first = 0
    while first < len(stops):
        begin = stops[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(stops, begin + PAIRED_UNITS, "right")))
        of_document = np.repeat(np.arange(first, last), np.diff(stops[first:last], prepend=begin))
        # Each document's distinct units with their number, and then its distinct pairs with theirs.
        keys, times = np.unique(of_document * max(1, len(many)) + flat[begin : stops[last - 1]], return_counts=True)
        document, unit = np.divmod(keys, max(1, len(many)))
        length = many[unit]
        source = np.repeat(before[unit] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        keys = np.repeat(document, length) * max(1, pairs) + pair_of[source]
        order = np.argsort(keys, kind="stable")
        keys, amounts = keys[order], np.repeat(times, length)[order]
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        links = np.add.reduceat(amounts, starts) if len(starts) else np.zeros(0, np.int64)
        found.append(tuple(column.astype(np.int32) for column in (*np.divmod(keys[starts], max(1, pairs)), links)))
        first = last
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def block_row(encoder: PairEncoder, number: int, ids: list, texts: list[str | None]) -> dict:
    """The row of a block of documents."""
    numbers: dict[str, int] = {}
    parts = [[numbers.setdefault(unit, len(numbers)) for unit in encoder.units(text)] if text else [] for text in texts]
    stops = np.cumsum([len(part) for part in parts], dtype=np.int64)
    flat = np.fromiter(chain.from_iterable(parts), np.int64, int(stops[-1]))
    units = encoder.known(list(numbers), np.bincount(flat, minlength=len(numbers)))
    del numbers
    head = heads(units)
    of_document = np.repeat(np.arange(len(parts)), np.diff(stops, prepend=0))
    bad = head[:, 0] == 0
    for i in set(of_document[bad[flat]].tolist()):
        parts[i] = []
    lengths = np.array([len(part) for part in parts], np.int64)
    flat, stops = flat[lengths[of_document] > 0], np.cumsum(lengths)
    del of_document
    many = head[:, 3]
    shown = [unit[at:] for unit, at in zip(units, (HEAD + 8 * many).tolist(), strict=True)]
    sha256 = [hashlib.sha256(b";".join([shown[i] for i in part])).hexdigest() if part else "" for part in parts]
    del shown, parts
    sums = {}
    for field, name in enumerate(("n_a", "n_b", "n_groups")):
        passed = np.concatenate([[0], np.cumsum(head[flat, field])])
        sums[name] = passed[stops] - passed[np.concatenate([[0], stops[:-1]])]
    all_pairs = np.frombuffer(b"".join([unit[HEAD : HEAD + 8 * n] for unit, n in zip(units, many.tolist(), strict=True)]), np.int64)
    del units
    pairs, pair_of = np.unique(all_pairs, return_inverse=True)
    document, place, links = _document_pairs(flat, stops, many, pair_of.ravel(), len(pairs))
    holders = np.bincount(place, minlength=len(pairs))
    used = np.flatnonzero(holders)
    renumbered = (np.cumsum(holders > 0) - 1).astype(np.int32)
    return {
        "block": number,
        "doc_id": ids,
        **sums,
        "sha256": sha256,
        "pair": pairs[used],
        "holders": holders[used].astype(np.int32),
        "ends": np.searchsorted(document, np.arange(len(texts)), "right"),
        "place": renumbered[place] if len(place) else place,
        "links": links,
    }


def _one_row(values: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values[field.name]], field.type) for field in schema], schema=schema)


def packed(values: dict, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(_one_row(values, schema))
    return sink.getvalue().to_pybytes()


def _block_reader(byte_vocabulary: str, piece_model: bytes, schema: pa.Schema, documents: pa.Schema) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(byte_vocabulary, piece_model)
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            found = block_row(encoder, number, ids, texts)
            return _one_row(found | {"documents": packed(found, documents)}, schema)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids.append(doc_id.as_py())
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= BLOCK_CHARACTERS:
                    yield row()
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield row()
        encoder.forget()

    return releasing(read)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Frames planned inside hand their rows to workers in batches of ``BATCH_BYTES`` at most; blocks are the same with any batches."""
    before = spark.conf.get(MAX_BATCH_BYTES, None)
    spark.conf.set(MAX_BATCH_BYTES, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(MAX_BATCH_BYTES) if before is None else spark.conf.set(MAX_BATCH_BYTES, before)


def _told(block: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block, from its row and the counts of its pairs."""
    if worker_encoder.cache_info().currsize:
        worker_encoder.cache_clear()
        release()
    documents = pa.ipc.open_stream(block["documents"][0].as_buffer()).read_all()
    pair = block["pair"][0].values.to_numpy()
    place, links, ends = (documents[name][0].values.to_numpy() for name in ("place", "links", "ends"))
    links = links.astype(np.int64)
    total, best = np.zeros(len(pair), np.int64), np.zeros(len(pair), bool)
    at = np.searchsorted(pair, counts["pair"].to_numpy())
    total[at] = counts["documents"].to_numpy()
    best[at] = np.asarray(counts["best"])
    begins = np.concatenate([[0], ends[:-1]])

    def summed(values: np.ndarray) -> np.ndarray:
        passed = np.concatenate([[0], np.cumsum(values)])
        return passed[ends] - passed[begins]

    columns = [documents[name][0].values for name in ("doc_id", "n_a", "n_b", "n_groups")]
    columns += [pa.array(summed(values)) for values in (links, links * best[place], links * total[place])]
    return pa.table([*columns, documents["sha256"][0].values], names=[field.split()[0] for field in _RESULT.split(", ")])


def alignments(docs: DataFrame, byte_vocabulary: str, piece_model: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its tokens in both vocabularies, groups and links, and how usual its links are in all of ``docs``."""
    schemas = [to_arrow_schema(StructType.fromDDL(columns)) for columns in (_BLOCK, _DOCUMENTS)]
    reader = _block_reader(Path(byte_vocabulary).read_text(), Path(piece_model).read_bytes(), *schemas)
    rows = docs.select(docs[ident].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    with small_batches(docs.sparkSession):
        blocks = written(rows.mapInArrow(reader, _BLOCK), "aligned")
    held = blocks.select(F.col("block").alias("holder"), F.explode(F.arrays_zip("pair", "holders")).alias("one")).select("holder", "one.pair", "one.holders")
    counted = held.groupBy("pair").agg(F.sum("holders").alias("documents"))
    a_id = F.shiftright("pair", 32).alias("a_id")
    counted = written(counted.withColumn("a_id", a_id), "pair_counts")
    highest = counted.groupBy("a_id").agg(F.max("documents").alias("highest"))
    flagged = counted.join(highest, "a_id").select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best"))
    counts = held.select("holder", "pair").join(flagged, "pair").select("holder", "pair", "documents", "best")
    return blocks.drop("holders").groupBy("block").cogroup(counts.groupBy("holder")).applyInArrow(_told, _RESULT)
