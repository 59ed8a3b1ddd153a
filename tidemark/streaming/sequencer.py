"""The sequencing rules as keyed stateful stream operators.

Books per arrival: channels are dealt into buckets, and a bucket is one key of the operator. Its state is one Arrow batch: a row per channel with its book
and its waiting sequences as sorted intervals. A micro-batch is merged into it by array operations (``intervals``), so that a channel with few messages costs
no call of its own, and one that waits for a long time costs as much state as it has holes. A bucket is read and written whole when any of its
channels has messages; with ``buckets_per_partition`` buckets to a state partition it should hold some thousands of channels at most.

Reports per tick: a channel is a key, with one book and bitmaps of ``CHUNK`` waiting sequences each, and a timer of its own while anything waits.

Rows of one micro-batch reach the operators in no promised order and are sorted by arrival there; across micro-batches the source has to keep the
order. The rows of one channel in one micro-batch are bounded by the source's admission options
(``maxFilesPerTrigger``, ``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``). Rows without channel, sequence or arrival time are no messages.
"""

from __future__ import annotations

import datetime
import io
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.sequencing import PRICE_STEP, PRICE_TYPE, known_messages
from tidemark.session import ship_by_value
from tidemark.streaming import intervals
from tidemark.streaming.intervals import JUMP_TO_ARRIVAL, JUMP_TO_PENDING, Overflow

CHUNK = 8192
ON_ARRIVAL, ON_TICK = "arrival", "tick"
BUCKETS_PER_PARTITION = 16

_REPORT = (
    "kind string, sequence bigint, trade_date bigint, price decimal(38,2), released bigint,"
    " at timestamp, calc_from bigint, calc_to bigint, skipped_from bigint, skipped_to bigint,"
    " pending_first bigint, pending_last bigint, pending_size bigint, remaining bigint"
)
_ARRIVAL = (
    "jumped boolean, sequence bigint, released bigint, total bigint, skipped_from bigint, skipped_to bigint,"
    " pending_last bigint, remaining bigint, trade_date bigint, at bigint"
)
_BOOK = (
    "sequence bigint, trade_date bigint, price decimal(38,2), pending bigint, pending_last bigint,"
    " advanced_at timestamp, ticking boolean"
)


class WaitingSequences:
    """A channel's waiting sequences: bitmaps in map state, those in use kept here until ``flush``.

    Every state call is a round trip out of the Python worker, so ``empty`` saves all look-ups of a channel
    known to have nothing waiting.
    """

    def __init__(self, state, empty: bool):
        self._state = state
        self._empty = empty
        self._loaded: dict[int, int] = {}
        self._stored: set[int] = set()

    def _chunk(self, number: int) -> int:
        if number not in self._loaded:
            value = None if self._empty else self._state.getValue((number,))
            self._loaded[number] = int.from_bytes(value[0], "little") if value else 0
            if value:
                self._stored.add(number)
        return self._loaded[number]

    def add(self, sequence: int) -> bool:
        """False if the sequence already waits."""
        number, bit = sequence // CHUNK, 1 << (sequence % CHUNK)
        bits = self._chunk(number)
        self._loaded[number] = bits | bit
        return not bits & bit

    def take_run(self, sequence: int) -> int:
        """Remove the contiguous run that starts at ``sequence``; its length (0 if there is none)."""
        taken = 0
        while True:
            number, offset = divmod(sequence + taken, CHUNK)
            bits = self._chunk(number)
            ahead = bits >> offset
            ones = (ahead ^ (ahead + 1)).bit_length() - 1
            if not ones:
                return taken
            self._loaded[number] = bits & ~(((1 << ones) - 1) << offset)
            taken += ones
            if offset + ones < CHUNK:
                return taken

    def first(self) -> int | None:
        """The smallest waiting sequence."""
        for number in sorted(self._numbers()):
            bits = self._chunk(number)
            if bits:
                return number * CHUNK + (bits & -bits).bit_length() - 1
        return None

    def _numbers(self) -> set[int]:
        if not self._empty:
            self._stored.update(key[0] for key in self._state.keys())
        return self._stored | set(self._loaded)

    def flush(self) -> None:
        for number, bits in self._loaded.items():
            if bits:
                self._state.updateValue((number,), (bits.to_bytes(CHUNK // 8, "little"),))
            elif number in self._stored:
                self._state.removeKey((number,))


class BucketSequencer(StatefulProcessor):
    """A book for every arrival that releases trades, for all channels of a bucket, with optional overflow jumps.

    Overflow: nothing could be released and more than ``max_pending`` sequences waited, or the last advance
    is more than ``max_age`` ago. The book then jumps to the arrival and forgets what waited, or to the smallest waiting sequence.
    """

    def __init__(self, limits: Overflow, order: list[str]):
        self.limits = limits
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("books", "batch binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrivals = pd.concat(list(rows), ignore_index=True).sort_values(self.order, na_position="first", ignore_index=True)
        stored = self.state.get()
        channels, dates, books, waiting = _unpacked(stored[0] if stored else None)
        codes = channels.get_indexer(arrivals["channel"])
        added = arrivals["channel"][codes < 0]
        # The first arrival of a channel is its base book and no trade.
        bases = added.drop_duplicates().index
        channels = channels.append(pd.Index(added[bases])) if len(channels) else pd.Index(added[bases])
        codes = channels.get_indexer(arrivals["channel"])
        first = arrivals.loc[bases]
        based = pd.DataFrame({"book": first["sequence"], "total": 0, "advanced": first["at"], "pending": 0}).astype("int64")
        books = pd.concat([books, based], ignore_index=True)
        dates = pd.concat([dates, first["trade_date"].astype("Int64")], ignore_index=True)
        trades = arrivals[["sequence", "at"]].assign(code=codes).drop(bases).reset_index(drop=True)
        books, waiting, reports = intervals.advance(books, waiting, trades, self.limits)
        self.state.update((_packed(channels, dates, books, waiting),))
        code = reports["code"].to_numpy(np.int64)
        yield reports.drop(columns=["code", "row"]).assign(
            channel=channels.take(code).to_numpy(), trade_date=dates.take(code).array, at=trades["at"].to_numpy()[reports["row"].to_numpy(np.int64)]
        )


def _unpacked(batch: bytes | None) -> tuple[pd.Index, pd.Series, pd.DataFrame, pd.DataFrame]:
    """Channels, trade dates, books and waiting intervals of a bucket."""
    if batch is None:
        empty = pd.DataFrame({name: np.zeros(0, np.int64) for name in intervals.BOOK})
        return pd.Index([]), pd.Series([], dtype="Int64"), empty, pd.DataFrame({name: np.zeros(0, np.int64) for name in ("code", "low", "high")})
    table = pa.ipc.open_stream(batch).read_all().combine_chunks()
    books = pd.DataFrame({name: table[name].to_numpy() for name in intervals.BOOK})
    spans = table["waiting"].combine_chunks()
    values = spans.flatten().to_numpy().reshape(-1, 2)
    code = np.repeat(np.arange(len(books)), np.asarray(spans.value_lengths()) // 2)
    waiting = pd.DataFrame({"code": code, "low": values[:, 0], "high": values[:, 1]})
    dates = table["trade_date"].to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
    return pd.Index(table["channel"].to_pandas()), dates, books, waiting


def _packed(channels: pd.Index, dates: pd.Series, books: pd.DataFrame, waiting: pd.DataFrame) -> bytes:
    ends = np.searchsorted(waiting["code"].to_numpy(), np.arange(len(books)), "right")
    spans = pa.ListArray.from_arrays(
        pa.array(2 * np.concatenate([[0], ends]), pa.int32()), pa.array(waiting[["low", "high"]].to_numpy(np.int64).ravel(), pa.int64())
    )
    columns = {name: pa.array(books[name].to_numpy(np.int64)) for name in intervals.BOOK}
    table = pa.table({"channel": pa.array(channels), "trade_date": pa.array(dates, pa.int64()), **columns, "waiting": spans})
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue()


class TickSequencer(StatefulProcessor):
    """One report of a channel per tick, with optional overflow jumps to the smallest waiting sequence, as ticks have no arrival."""

    def __init__(self, limits: Overflow, tick_seconds: int = 1, step: Decimal = PRICE_STEP):
        self.tick_millis = tick_seconds * 1000
        self.limits = limits
        self.step = step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.book_state = handle.getValueState("book", _BOOK)
        self.waiting_state = handle.getMapState("waiting", "chunk bigint", "bits binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.book_state.get()
        book = dict(zip(_BOOK_NAMES, stored, strict=True)) if stored else None
        waiting = WaitingSequences(self.waiting_state, empty=book is None or not book["pending"])
        for row in sorted(rows, key=lambda row: tuple(row["arrival"].values())):
            sequence, at = row["sequence"], row["arrival"]["at"]
            if book is None:
                book = {
                    "sequence": sequence,
                    "trade_date": row["arrival"]["trade_date"],
                    "price": Decimal(0),
                    "pending": 0,
                    "pending_last": None,
                    "advanced_at": at,
                    "ticking": False,
                }
            elif sequence > book["sequence"] and waiting.add(sequence):
                book["pending"] += 1
                book["pending_last"] = max(sequence, book["pending_last"] or sequence)
        self._save(book, waiting, timerValues)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        waiting = WaitingSequences(self.waiting_state, empty=False)
        book = dict(zip(_BOOK_NAMES, self.book_state.get(), strict=True))
        book["ticking"] = False
        now = _utc(expiredTimerInfo.getExpiryTimeInMs())
        size, first, last = book["pending"], waiting.first(), book["pending_last"]
        report = self._advance(key[0], book, waiting, now, "tick")
        if not report["released"] and self._overflows(book, size, now):
            report = self._jump(key[0], book, waiting, now)
        self._save(book, waiting, timerValues)
        yield Row(**{**report.asDict(), "pending_first": first, "pending_last": last, "pending_size": size})

    def _save(self, book: dict, waiting: WaitingSequences, timerValues) -> None:
        """Keep the state, and one tick ahead for as long as something waits."""
        if book["pending"] and not book["ticking"]:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.tick_millis)
            book["ticking"] = True
        waiting.flush()
        self.book_state.update(tuple(book[name] for name in _BOOK_NAMES))

    def _overflows(self, book: dict, before: int, at: datetime.datetime) -> bool:
        return bool(self.limits) and self.limits.exceeded(before, (at - book["advanced_at"]) // datetime.timedelta(microseconds=1))

    def _advance(self, channel, book: dict, waiting: WaitingSequences, at, kind: str) -> Row:
        start = book["sequence"] + 1
        taken = waiting.take_run(start)
        if taken:
            book["sequence"] += taken
            book["price"] += self.step * taken
            book["pending"] -= taken
            book["advanced_at"] = at
            if not book["pending"]:
                book["pending_last"] = None
        return self._row(channel, kind, book, taken, at, start if taken else None)

    def _jump(self, channel, book: dict, waiting: WaitingSequences, at) -> Row:
        skipped_from, first = book["sequence"] + 1, waiting.first()
        book["sequence"] = first - 1
        return self._skipping(self._advance(channel, book, waiting, at, "overflow"), skipped_from, first - 1)

    @staticmethod
    def _skipping(row: Row, skipped_from: int, skipped_to: int) -> Row:
        return Row(**{**row.asDict(), "skipped_from": skipped_from, "skipped_to": skipped_to})

    @staticmethod
    def _row(channel, kind: str, book: dict, released: int, at, calc_from: int | None) -> Row:
        return Row(
            channel=channel,
            kind=kind,
            sequence=book["sequence"],
            trade_date=book["trade_date"],
            price=book["price"],
            released=released,
            at=at,
            calc_from=calc_from,
            calc_to=book["sequence"] if released else None,
            skipped_from=None,
            skipped_to=None,
            pending_first=None,
            pending_last=book["pending_last"],
            pending_size=book["pending"] + released,
            remaining=book["pending"],
        )


def _utc(millis: int) -> datetime.datetime:
    """A time as the rows' own times reach the worker: without zone, in that of the session, which is UTC for streams."""
    return datetime.datetime.fromtimestamp(millis / 1000, datetime.timezone.utc).replace(tzinfo=None)


_BOOK_NAMES = ["sequence", "trade_date", "price", "pending", "pending_last", "advanced_at", "ticking"]


ship_by_value(__name__)
ship_by_value(intervals.__name__)


def sequence_channels(
    messages: DataFrame,
    emit: str = ON_ARRIVAL,
    tick_seconds: int = 1,
    max_pending: int | None = None,
    max_age_seconds: int | None = None,
    on_overflow: str = JUMP_TO_ARRIVAL,
    step: Decimal = PRICE_STEP,
    buckets_per_partition: int = BUCKETS_PER_PARTITION,
) -> DataFrame:
    """Books per arrival or reports per tick of streaming messages (channel, sequence, arrival); append mode.

    The number of buckets follows that of the state partitions, which a checkpoint fixes as well.
    """
    limits = Overflow(max_pending, None if max_age_seconds is None else max_age_seconds * 1_000_000, on_overflow)
    messages = known_messages(messages)
    if emit == ON_TICK:
        output = T.StructType([messages.schema["channel"], *T.StructType.fromDDL(_REPORT).fields])
        return messages.groupBy("channel").transformWithState(
            TickSequencer(limits, tick_seconds, step), output, "Append", "ProcessingTime"
        )
    buckets = buckets_per_partition * int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [field.name for field in messages.schema["arrival"].dataType.fields]
    flat = messages.select(
        "channel",
        "sequence",
        F.unix_micros("arrival.at").alias("at"),
        *[F.col(f"arrival.{name}").alias("trade_date" if name == "trade_date" else f"tie_{name}") for name in order[1:]],
        F.pmod(F.xxhash64("channel"), F.lit(buckets)).alias("bucket"),
    )
    output = T.StructType(
        [messages.schema["channel"], *T.StructType.fromDDL(_ARRIVAL).fields]
    )
    reports = flat.groupBy("bucket").transformWithStateInPandas(
        BucketSequencer(limits, flat.columns[2:-1]), output, "Append", "None"
    )
    released = F.col("released")
    return reports.select(
        "channel",
        F.when(F.col("jumped"), "overflow").otherwise("book").alias("kind"),
        "sequence",
        "trade_date",
        (F.lit(step).cast(PRICE_TYPE) * F.col("total").cast("decimal(20,0)")).cast(PRICE_TYPE).alias("price"),
        "released",
        F.timestamp_micros("at").alias("at"),
        (F.col("sequence") - released + 1).alias("calc_from"),
        F.col("sequence").alias("calc_to"),
        "skipped_from",
        "skipped_to",
        F.lit(None).cast("bigint").alias("pending_first"),
        "pending_last",
        (F.col("remaining") + released).alias("pending_size"),
        "remaining",
    )
