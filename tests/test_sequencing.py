import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.model import ORDERS, replay
from tidemark.operators import ranges, sequencing
from tidemark.operators.ranges import RANGE
from tidemark.sources.messages import sequenced
from tidemark.streaming.replay import run_to_table
from tidemark.streaming.sequencer import sequence_channels

random.seed(7)
CASES = list(ORDERS.values()) + [
    [random.randint(0, 12) for _ in range(random.randint(1, 25))] for _ in range(60)
]


def as_messages(spark, cases):
    rows = [(channel, sequence, position) for channel, order in enumerate(cases) for position, sequence in enumerate(order)]
    frame = spark.createDataFrame(rows, "channel bigint, sequence bigint, position bigint")
    return sequenced(
        frame, F.col("channel"), F.col("sequence"), F.timestamp_seconds("position"), ["position"], F.col("position") * 1000
    )


@pytest.fixture(scope="module")
def messages(spark):
    return as_messages(spark, CASES).cache()


def test_rows_that_are_no_messages_are_rejected_everywhere(spark):
    rows = [("a", 1, 0), (None, 1, 1), ("a", None, 2), ("a", 2, None), ("a", 2, 3), (None, None, None)]
    frame = spark.createDataFrame(rows, "channel string, sequence bigint, position bigint")
    made = sequenced(frame, F.col("channel"), F.col("sequence"), F.timestamp_seconds("position"), ["position"], F.col("position"))
    assert sorted(r["reason"] for r in sequencing.rejected(made).collect()) == ["no arrival time", "no channel", "no channel", "no sequence"]
    assert [r["channel"] for r in sequencing.base_books(made).collect()] == ["a"]
    assert [(r["channel"], r["sequence"]) for r in sequencing.books(made).collect()] == [("a", 2)]
    assert sorted(r["class"] for r in sequencing.classify(made).collect()) == ["base", "in_order"]
    assert sequencing.first_arrivals(made).count() == 2


def test_equal_arrivals_have_one_base(spark):
    frame = spark.createDataFrame([("a", 1, 0)] * 3 + [("a", 2, 1)] * 2, "channel string, sequence bigint, position bigint")
    made = sequenced(frame, F.col("channel"), F.col("sequence"), F.timestamp_seconds("position"), ["position"], F.col("position"))
    assert sorted(r["class"] for r in sequencing.classify(made).collect()) == ["base", "duplicate", "in_order", "late", "late"]


# One range holds all channels; with many a channel lies in several.
@pytest.mark.parametrize("parts", [1, 7, 200])
def test_classes(messages, parts):
    rows = sequencing.classify(messages, parts).select("channel", "arrival.position", "class").collect()
    found = {(row[0], row[1]): row[2] for row in rows}
    expected = {
        (channel, position): kind
        for channel, order in enumerate(CASES)
        for position, kind in enumerate(replay(order)[0])
    }
    assert found == expected


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_books_and_emissions(messages, parts):
    books = {row["channel"]: (row["sequence"], row["price"]) for row in sequencing.books(messages, parts=parts).collect()}
    emitted = sorted(
        (row["channel"], row["released_at"].timestamp(), row["sequence"], row["price"], row["released"])
        for row in sequencing.emissions(messages, parts=parts).collect()
    )
    expected_books, expected_emitted = {}, []
    for channel, order in enumerate(CASES):
        _, events, _, final = replay(order)
        expected_books[channel] = (final.book, final.price)
        expected_emitted += [(channel, float(at), book, price, count) for at, _, book, price, count, _ in events]
    assert books == expected_books
    assert emitted == sorted(expected_emitted)


@pytest.mark.parametrize("parts", [1, 200])
def test_in_order_pending_and_gaps(messages, parts):
    in_order = {tuple(r) for r in sequencing.in_order(messages, parts).select("channel", "sequence").collect()}
    pending = {tuple(r) for r in sequencing.pending(messages, parts).select("channel", "sequence").collect()}
    gaps = {tuple(r) for r in sequencing.gaps(messages, parts).collect()}
    ranges = {tuple(r) for r in sequencing.backfill_ranges(messages, parts).collect()}
    want_order, want_pending, want_gaps, want_ranges = set(), set(), set(), set()
    for channel, order in enumerate(CASES):
        _, _, drained, final = replay(order)
        want_order |= {(channel, sequence) for sequence in drained}
        want_pending |= {(channel, sequence) for sequence in final.waiting}
        present = sorted({sequence for sequence in order if sequence >= order[0]})
        for left, right in zip(present, present[1:]):
            if right > left + 1:
                want_gaps.add((channel, left + 1, right - 1, right - left - 1))
        if final.waiting:
            want_ranges.add((channel, final.book + 1, max(final.waiting)))
    assert (in_order, pending, gaps, ranges) == (want_order, want_pending, want_gaps, want_ranges)


@pytest.mark.parametrize("parts", [1, 200])
def test_ticks(messages, parts):
    seconds = 3
    found = {(r["channel"], r["tick"]): r.asDict() for r in sequencing.ticks(messages, seconds, parts).collect()}
    for channel, order in enumerate(CASES):
        tick = lambda position: position // seconds + 1
        _, _, drained, _ = replay(order)
        came = {}
        for position, sequence in enumerate(order):
            if sequence > order[0]:
                came.setdefault(sequence, tick(position))
        done = {sequence: tick(position) for sequence, position in drained.items()}
        assert {number for c, number in found if c == channel} == set(came.values())
        for number in set(came.values()):
            row = found[channel, number]
            waiting = [s for s in came if came[s] <= number and done.get(s, number) >= number]
            released = [s for s in done if done[s] == number]
            assert row["pending_size"] == len(waiting)
            assert row["pending_first"] == min(waiting)
            assert row["pending_last"] == max(s for s in came if came[s] <= number)
            assert row["remaining_first"] == min((s for s in waiting if s not in released), default=None)
            assert row["calculated"] == len(released)
            assert row["remaining"] == len(waiting) - len(released)
            assert row["calc_from"] == (min(released) if released else None)
            assert row["book_sequence"] == max([order[0], *[s for s in done if done[s] <= number]])


def test_idle_ticks_fill_the_time_between_reports(messages):
    """With the reports they cover every tick from the first report to the last, while anything waits."""
    reports, idle = {}, {}
    for row in sequencing.ticks(messages, 1).collect():
        reports.setdefault(row["channel"], {})[row["tick"]] = row["remaining"], row["remaining_first"]
    for row in sequencing.idle_ticks(messages, 1).collect():
        assert (row["pending_size"], row["pending_first"]) == reports[row["channel"]][row["tick_from"] - 1]
        last = max(reports[row["channel"]])
        for tick in range(row["tick_from"], (row["tick_to"] or last) + 1):
            idle.setdefault(row["channel"], set()).add(tick)
        assert (row["tick_to"] is None) == (row["tick_from"] == last + 1)
    for channel, known in reports.items():
        left = 0
        for tick in range(min(known), max(known) + 1):
            if tick in known:
                left = known[tick][0]
            else:
                assert (tick in idle.get(channel, set())) == (left > 0)


def test_a_sparse_hot_channel_is_spread_evenly(spark):
    """Sequences 2**20 apart, one in a hundred followed by its successor: no range has much more than its share of the rows."""
    parts, rows = 16, 200_000
    sequence = F.col("id") * (1 << 20) + F.when(F.col("id") % 100 == 1, 1 - (1 << 20)).otherwise(0)
    frame = spark.range(rows).select("id", sequence.alias("sequence"), (F.col("id") * 7919 % rows + F.when(F.col("id") == 0, -rows).otherwise(0)).alias("position"))
    made = sequenced(frame, F.lit("hot"), F.col("sequence"), F.timestamp_seconds("position"), ["position"], F.col("position"))
    sizes = [r[0] for r in sequencing._in_ranges(made, parts).groupBy(RANGE).count().select("count").collect()]
    assert len(sizes) == parts and max(sizes) < 1.5 * rows / parts
    found = sequencing.ordered_messages(made, parts)
    assert found.count() == rows
    assert [(r.sequence, r.release.position) for r in found.filter("release is not null").collect()] == [(1, 7919)]
    assert sequencing.gaps(made, parts).count() == rows - 1 - rows // 100
    assert sequencing.books(made, parts=parts).first()["sequence"] == 1


def test_one_run_over_many_ranges(spark):
    """A run of one channel that no range ends; the first arrival lies in its middle, and the row after it comes last."""
    rows = [("a", n, n if n != 501 else 5000) for n in range(1000)]
    frame = spark.createDataFrame([(c, n, -1 if n == 500 else p) for c, n, p in rows], "channel string, sequence bigint, position bigint")
    made = sequenced(frame, F.col("channel"), F.col("sequence"), F.timestamp_seconds("position"), ["position"], F.col("position"))
    found = sequencing.ordered_messages(made, 20).collect()
    assert {r.run_end for r in found} == {999} and {r.base for r in found} == {500}
    assert all((r.release.position if r.release else None) == (5000 if r.sequence > 500 else None) for r in found)


def test_empty_input(spark):
    nothing = as_messages(spark, [[1]]).filter("channel < 0")
    assert sequencing.books(nothing).count() == 0
    assert sequencing.classify(nothing).count() == 0


def test_price_step(messages):
    prices = sequencing.books(messages, step=Decimal("1.25")).filter("channel = 0").first()["price"]
    assert prices == Decimal("3.75")


@pytest.mark.parametrize(
    "options",
    [{}, {"max_pending": 1, "on_overflow": "arrival"}, {"max_pending": 2, "on_overflow": "min_pending"}],
    ids=["plain", "jump to arrival", "jump to pending"],
)
def test_stream(spark, messages, options):
    """Three slices, cut in the middle of the channels."""
    rows = messages.select("channel", "sequence", "arrival")
    slices = [rows.filter(f"arrival.position between {low} and {high}") for low, high in ((0, 2), (3, 6), (7, 99))]
    emitted = run_to_table(spark, slices, lambda stream: sequence_channels(stream, **options), "test")
    found = sorted(
        (r["channel"], int(r["at"].timestamp()), r["kind"], r["sequence"], r["price"], r["released"], r["skipped_from"], r["skipped_to"])
        for r in emitted.collect()
    )
    expected = []
    for channel, order in enumerate(CASES):
        for at, kind, book, price, count, skipped in replay(order, **options)[1]:
            expected.append((channel, at, kind, book, price, count, *(skipped or (None, None))))
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_overflow_by_age_and_highest_waiting(spark):
    """Nothing has advanced for more than ten seconds: the book jumps to the arrival, and nothing waits any more."""
    rows = [("a", 0, 0), ("a", 2, 1), ("a", 9, 2), ("a", 5, 20), ("a", 7, 21), ("a", 6, 22)]
    frame = spark.createDataFrame(rows, "channel string, sequence bigint, position bigint")
    made = sequenced(frame, F.col("channel"), F.col("sequence"), F.timestamp_seconds("position"), ["position"], F.col("position"))
    emitted = run_to_table(spark, [made], lambda stream: sequence_channels(stream, max_age_seconds=10), "age")
    found = [
        (r["kind"], r["sequence"], r["released"], r["skipped_from"], r["skipped_to"], r["pending_last"], r["remaining"])
        for r in emitted.orderBy("at").collect()
    ]
    assert found == [("overflow", 5, 1, 1, 4, None, 0), ("book", 7, 2, None, None, None, 0)]


def test_classes_of_single_arrivals_need_no_join_of_all_messages(spark, tmp_path):
    """Where a sequence comes once its class is that of the ordered row: all that is joined is broadcast."""
    rows = [(c, s, (datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s % 7 * 10 + c), s)) for c in range(300) for s in range(c % 5, 12)]
    made = spark.createDataFrame(rows, "channel long, sequence long, arrival struct<at: timestamp, trade_date: bigint>")
    found = sequencing.classify(made)
    assert found.count() == len(rows)
    assert "SortMergeJoin" not in found._jdf.queryExecution().toString()


def test_running_on_kept_ranges_equals_dealing_anew(spark):
    rows = [(k, t, (7 * t + k) % 11) for k in range(3) for t in range(40)]
    made = spark.createDataFrame(rows, "k long, t long, v long")
    kept = ranges.running(made, ["k"], ["t"], maxima={"most": F.col("v")}, keep=True)
    after = ranges.running(kept, ["k"], ["t"], maxima={"later": F.col("v")}, own=False, backward=True)
    assert RANGE not in after.columns
    expected = {(k, t): max((v for j, u, v in rows if j == k and u > t), default=None) for k, t, _ in rows}
    assert {(r.k, r.t): r.later for r in after.collect()} == expected
