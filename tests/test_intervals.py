"""The array form of the sequencing rules, slice by slice, against the model that takes one message at a time."""

import random
import time

import numpy as np
import pandas as pd
import pytest

from tests.model import ORDERS, Channel
from tidemark.streaming.intervals import BOOK, JUMP_TO_PENDING, Overflow, Waiting, advance

random.seed(11)
CASES = list(ORDERS.values()) + [[random.randint(-3, 14) for _ in range(random.randint(1, 40))] for _ in range(150)]


def replayed(options, cuts):
    """Reports of all channels, fed in slices of ``cuts`` messages, and the final books and waiting sequences."""
    limits = Overflow(options.get("max_pending"), None, options.get("on_overflow", "arrival"))
    books = pd.DataFrame({name: pd.Series(dtype="int64") for name in BOOK})
    intervals = pd.DataFrame({name: pd.Series(dtype="int64") for name in ("code", "low", "high")})
    found = []
    longest = max(map(len, CASES))
    for first in range(0, longest, cuts):
        rows = [(c, s, p) for c, order in enumerate(CASES) for p, s in enumerate(order) if first <= p < first + cuts]
        rows.sort(key=lambda r: (r[2], r[0]))
        if first == 0:
            for c, s, _ in [r for r in rows if r[2] == 0]:
                books.loc[c] = dict(zip(BOOK, (s, 0, 0, 0), strict=True))
            books = books.sort_index()
            rows = [r for r in rows if r[2] > 0]
        if not rows:
            continue
        frame = pd.DataFrame(rows, columns=["code", "sequence", "at"])
        books, intervals, reports = advance(books, intervals, frame, limits)
        for r in reports.itertuples():
            skipped = None if r.skipped_from is pd.NA else (r.skipped_from, r.skipped_to)
            last = None if r.pending_last is pd.NA else r.pending_last
            found.append((r.code, frame["at"][r.row], r.jumped, r.sequence, r.released, r.total, skipped, last, r.remaining))
    waiting = {}
    for r in intervals.itertuples():
        waiting.setdefault(r.code, set()).update(range(r.low, r.high + 1))
    return sorted(found, key=str), books, waiting


@pytest.mark.parametrize("cuts", [1, 3, 100])
@pytest.mark.parametrize(
    "options",
    [{}, {"max_pending": 1}, {"max_pending": 0}, {"max_pending": 2, "on_overflow": "min_pending"}, {"max_pending": 1, "on_overflow": "min_pending"}],
)
def test_equals_the_model(options, cuts):
    expected, finals = [], {}
    for c, order in enumerate(CASES):
        channel, total = Channel(**options), 0
        for position, sequence in enumerate(order):
            kind, event = channel.arrive(sequence)
            if event:
                what, book, _, count, skipped = event
                total += count
                last = max(channel.waiting, default=None)
                expected.append((c, position, what == "overflow", book, count, total, skipped, last, len(channel.waiting)))
        finals[c] = channel
    found, books, waiting = replayed(options, cuts)
    assert found == sorted(expected, key=str)
    assert {c: int(b) for c, b in books["book"].items()} == {c: f.book for c, f in finals.items()}
    assert {c: int(p) for c, p in books["pending"].items()} == {c: len(f.waiting) for c, f in finals.items()}
    assert waiting == {c: f.waiting for c, f in finals.items() if f.waiting}


def test_intervals_stay_joined_and_apart():
    random.seed(2)
    waiting, known = Waiting([], []), set()
    for sequence in [random.randint(0, 60) for _ in range(200)]:
        assert waiting.add(sequence) == (sequence not in known)
        known.add(sequence)
        spans = list(zip(waiting.low, waiting.high, strict=True))
        assert {s for low, high in spans for s in range(low, high + 1)} == known
        assert all(b[0] > a[1] + 1 for a, b in zip(spans, spans[1:], strict=False))


def test_a_long_shuffled_run_is_two_intervals_at_most():
    rows = np.random.default_rng(1).permutation(np.arange(1, 200_001))
    books = pd.DataFrame({"book": [0], "total": [0], "advanced": [0], "pending": [0]})
    intervals = pd.DataFrame({"code": [], "low": [], "high": []}, dtype=np.int64)
    held = rows[rows != 1]
    frame = pd.DataFrame({"code": 0, "sequence": held, "at": np.arange(len(held))})
    books, intervals, reports = advance(books, intervals, frame, Overflow())
    assert len(reports) == 0 and intervals.values.tolist() == [[0, 2, 200_000]]
    books, intervals, reports = advance(books, intervals, pd.DataFrame({"code": [0], "sequence": [1], "at": [0]}), Overflow())
    assert reports["released"].tolist() == [200_000] and not len(intervals) and books["pending"].tolist() == [0]


def test_channels_that_jump_cost_no_table_operation_each():
    """20,000 channels jump in one micro-batch; each also gives what it gives alone."""
    count, start, old = 20_000, 1_000_000, 10
    books = pd.DataFrame({"book": np.arange(count) % 7, "total": 0, "advanced": start, "pending": 0}).astype("int64")
    waiting = pd.DataFrame({name: np.zeros(0, np.int64) for name in ("code", "low", "high")})
    code = np.tile(np.arange(count), 3)
    rows = pd.DataFrame({"code": code, "sequence": code % 7 + np.repeat([3, 5, 4], count), "at": start + np.repeat([5, 20, 30], count)}).astype("int64")
    limits = Overflow(None, old, JUMP_TO_PENDING)
    began = time.process_time()
    after, left, reports = advance(books, waiting, rows, limits)
    assert time.process_time() - began < 5
    assert (after["pending"] == 0).all() and not len(left) and reports["jumped"].sum() == count
    for one in range(0, count, 2500):
        own = rows[rows["code"] == one].assign(code=0).reset_index(drop=True)
        alone, _, told = advance(books.iloc[[one]].reset_index(drop=True), waiting, own, limits)
        assert alone.iloc[0].tolist() == after.iloc[one].tolist()
        mine = reports[reports["code"] == one]
        assert mine["sequence"].tolist() == told["sequence"].tolist() and mine["released"].tolist() == told["released"].tolist()
