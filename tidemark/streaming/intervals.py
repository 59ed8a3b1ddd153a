"""The sequencing rules for many channels and one micro-batch at once, on arrays.

A channel's waiting sequences are sorted intervals. ``advance`` merges the sequences that came with them: in order of (channel, sequence) the run
after the book is the items up to the first hole, an item is released by the latest arrival of the run so far, and each arrival that
releases is one book. Where too many wait or the last advance is too old at an arrival that releases nothing, the book jumps, and what follows depends on
that; only channels in which this happens are gone through message by message.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd

JUMP_TO_ARRIVAL, JUMP_TO_PENDING = "arrival", "min_pending"
BOOK = ["book", "total", "advanced", "pending"]
REPORT = ["code", "row", "jumped", "sequence", "released", "total", "skipped_from", "skipped_to", "pending_last", "remaining"]


@dataclass
class Overflow:
    """``max_pending`` sequences, ``max_age`` microseconds and where the book jumps; None is no limit."""

    max_pending: int | None = None
    max_age: int | None = None
    jump_to: str = JUMP_TO_ARRIVAL

    def __bool__(self) -> bool:
        return self.max_pending is not None or self.max_age is not None

    def exceeded(self, pending, age):
        too_many = pending > self.max_pending if self.max_pending is not None else False
        too_old = age > self.max_age if self.max_age is not None else False
        return too_many | too_old


class Waiting:
    """The waiting sequences of one channel as intervals, for the walk message by message."""

    def __init__(self, low: list[int], high: list[int]):
        self.low, self.high = low, high

    def add(self, sequence: int) -> bool:
        """False if the sequence already waits."""
        at = bisect_right(self.low, sequence)
        if at and self.high[at - 1] >= sequence:
            return False
        joins_before = at > 0 and self.high[at - 1] == sequence - 1
        joins_after = at < len(self.low) and self.low[at] == sequence + 1
        if joins_before and joins_after:
            self.high[at - 1] = self.high.pop(at)
            del self.low[at]
        elif joins_before:
            self.high[at - 1] = sequence
        elif joins_after:
            self.low[at] = sequence
        else:
            self.low.insert(at, sequence)
            self.high.insert(at, sequence)
        return True

    def take_first(self) -> tuple[int, int]:
        return self.low.pop(0), self.high.pop(0)


def _walk(book: dict, waiting: Waiting, rows: list[tuple[int, int, int]], limits: Overflow):
    """Reports of one channel, message by message; ``book`` and ``waiting`` are changed. Rows are (row, sequence, time)."""
    for row, sequence, at in rows:
        if sequence <= book["book"] or not waiting.add(sequence):
            continue
        before, skipped = book["pending"], (None, None)
        book["pending"] += 1
        jumps = False
        if sequence != book["book"] + 1:
            if not limits.exceeded(before, at - book["advanced"]):
                continue
            jumps = True
            if limits.jump_to == JUMP_TO_ARRIVAL:
                waiting.low, waiting.high = [sequence], [sequence]
                book["pending"] = 1
            skipped = book["book"] + 1, waiting.low[0] - 1
        low, high = waiting.take_first()
        released = high - low + 1
        book.update(book=high, total=book["total"] + released, advanced=at, pending=book["pending"] - released)
        last = waiting.high[-1] if waiting.high else None
        yield row, jumps, high, released, book["total"], *skipped, last, book["pending"]


def _upto(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return np.searchsorted(keys, wanted, "right")


def advance(books: pd.DataFrame, intervals: pd.DataFrame, rows: pd.DataFrame, limits: Overflow) -> tuple[pd.DataFrame, pd.DataFrame, pd.DataFrame]:
    """New books and intervals, and the reports (``REPORT``) of the arrivals that release trades.

    ``books`` has a row per channel code (its index) with ``BOOK``, ``intervals`` the waiting ``code``, ``low``, ``high`` in order, and ``rows``
    the arrivals in order with ``code``, ``sequence`` and ``at``.
    """
    code, sequence, at = (rows[name].to_numpy(np.int64) for name in ("code", "sequence", "at"))
    row = np.arange(len(rows))
    base = len(rows) + 2
    books = books.copy()
    book, pending, advanced = (books[name].to_numpy(np.int64) for name in ("book", "pending", "advanced"))
    above = np.flatnonzero(sequence > book[code])
    above = above[np.lexsort((above, sequence[above], code[above]))]
    fresh = np.ones(len(above), bool)
    fresh[1:] = (np.diff(code[above]) != 0) | (np.diff(sequence[above]) != 0)
    above = above[fresh]
    # Intervals and single sequences in one order; a sequence inside an interval already waits.
    i_code, i_low, i_high = (intervals[name].to_numpy(np.int64) for name in ("code", "low", "high"))
    item_code, low = np.concatenate([i_code, code[above]]), np.concatenate([i_low, sequence[above]])
    high, came = np.concatenate([i_high, sequence[above]]), np.concatenate([np.full(len(i_code), -1), row[above]])
    order = np.lexsort((came, low, item_code))
    item_code, low, high, came = item_code[order], low[order], high[order], came[order]
    latest = np.maximum.accumulate(np.where(came < 0, np.arange(len(came)), -1)) if len(came) else came
    inside = (came >= 0) & (latest >= 0)
    inside &= (item_code[latest] == item_code) & (high[latest] >= low)
    item_code, low, high, came = item_code[~inside], low[~inside], high[~inside], came[~inside]
    size, place = high - low + 1, np.arange(len(low))
    first = np.ones(len(low), bool)
    first[1:] = np.diff(item_code) != 0
    before = np.where(first, book[item_code], np.concatenate([[0], high[:-1]]))
    holes = np.cumsum(low != before + 1)
    start = np.maximum.accumulate(np.where(first, place, 0)) if len(low) else place
    in_run = holes - (holes[start] - (low[start] != before[start] + 1)) == 0
    release = np.maximum.accumulate(item_code * base + came + 1) if len(low) else place
    # One book for each arrival that releases: the last item of its part of the run.
    run = np.flatnonzero(in_run)
    ends = np.append(np.diff(release[run]) != 0, True)[: len(run)]
    emitted = run[ends]
    passed = np.cumsum(size[run])[ends]
    released = np.diff(passed, prepend=0)
    e_code, e_key = item_code[emitted], release[emitted]
    total = np.cumsum(released)
    e_first = np.searchsorted(e_code, e_code)
    done = total - (total - released)[e_first]
    # Accepted arrivals in order of arrival, to tell what waits at each of them.
    accepted = np.flatnonzero(came >= 0)
    accepted = accepted[np.argsort(item_code[accepted] * base + came[accepted], kind="stable")]
    a_code = item_code[accepted]
    a_key = a_code * base + came[accepted] + 1
    arrived = np.arange(1, len(accepted) + 1) - np.searchsorted(a_code, a_code)
    last_interval = np.full(len(books), -1)
    last_interval[item_code[came < 0]] = place[came < 0]
    seen = np.maximum.accumulate(accepted) if len(accepted) else accepted
    e_at = _upto(a_key, e_key) - 1
    remaining = pending[e_code] + arrived[e_at] - done
    last = high[np.maximum(seen[e_at], last_interval[e_code])]
    reports = pd.DataFrame(
        {
            "code": e_code,
            "row": e_key % base - 1,
            "jumped": False,
            "sequence": high[emitted],
            "released": released,
            "total": books["total"].to_numpy(np.int64)[e_code] + done,
            "skipped_from": pd.array([pd.NA] * len(emitted), "Int64"),
            "skipped_to": pd.array([pd.NA] * len(emitted), "Int64"),
            "pending_last": pd.array(np.where(remaining > 0, last, 0), "Int64"),
            "remaining": remaining,
        }
    )
    reports.loc[remaining == 0, "pending_last"] = pd.NA
    walked = np.zeros(0, np.int64)
    if limits:
        earlier = _upto(e_key, a_key - 1) - 1  # the book before the arrival
        known = (earlier >= 0) & (e_code[np.maximum(earlier, 0)] == a_code) if len(e_code) else np.zeros(len(a_code), bool)
        earlier = np.where(known, earlier, 0)
        drained = np.where(known, done[earlier], 0) if len(done) else np.zeros(len(a_code), np.int64)
        since = np.where(known, at[e_key[earlier] % base - 1], advanced[a_code]) if len(done) else advanced[a_code]
        over = limits.exceeded(pending[a_code] + arrived - 1 - drained, at[came[accepted]] - since)
        walked = np.unique(a_code[over & ~np.isin(a_key, e_key)])
    by_array = ~np.isin(e_code, walked)
    last_of_code = np.append(np.diff(e_code) != 0, True)[: len(e_code)] & by_array
    moved = e_code[last_of_code]
    books.loc[moved, "book"] = reports["sequence"].to_numpy()[last_of_code]
    books.loc[moved, "total"] = reports["total"].to_numpy()[last_of_code]
    books.loc[moved, "advanced"] = at[reports["row"].to_numpy()[last_of_code]]
    touched = np.setdiff1d(np.unique(code), walked)
    left = pd.Series(np.where(in_run, 0, size)).groupby(item_code).sum()
    books.loc[touched, "pending"] = left.reindex(touched, fill_value=0).to_numpy()
    waits = np.flatnonzero(~in_run & ~np.isin(item_code, walked))
    opens = np.ones(len(waits), bool)
    opens[1:] = (np.diff(item_code[waits]) != 0) | (low[waits][1:] != high[waits][:-1] + 1)
    closes = np.append(opens[1:], True)[: len(waits)]
    kept = pd.DataFrame({"code": item_code[waits[opens]], "low": low[waits[opens]], "high": high[waits[closes]]})
    if not len(walked):
        return books, kept, reports
    found, kept_walked = _walk_codes(books, intervals, rows, walked, limits)
    reports = pd.concat([reports[by_array], found], ignore_index=True)
    return books, pd.concat([kept, kept_walked]).sort_values(["code", "low"], ignore_index=True), reports


def _walk_codes(books: pd.DataFrame, intervals: pd.DataFrame, rows: pd.DataFrame, codes: np.ndarray, limits: Overflow):
    """``_walk`` for some channels, given in order; their books are changed.

    All rows are cut into channels at once and the books set at once, so that a channel costs no table operation of its own.
    """
    code = rows["code"].to_numpy(np.int64)
    places = np.flatnonzero(np.isin(code, codes))
    places = places[np.argsort(code[places], kind="stable")]
    row_ends = np.searchsorted(code[places], codes, "right").tolist()
    messages = list(zip(places.tolist(), *(rows[name].to_numpy(np.int64)[places].tolist() for name in ("sequence", "at")), strict=True))
    i_code = intervals["code"].to_numpy(np.int64)
    i_low, i_high = intervals["low"].tolist(), intervals["high"].tolist()
    span_starts, span_ends = (np.searchsorted(i_code, codes, side).tolist() for side in ("left", "right"))
    values = books[BOOK].to_numpy(np.int64)[codes].tolist()
    told, left, start = [], [], 0
    for i, one in enumerate(codes.tolist()):
        spans = slice(span_starts[i], span_ends[i])
        waiting = Waiting(i_low[spans], i_high[spans])
        book = dict(zip(BOOK, values[i], strict=True))
        told += [(one, *report) for report in _walk(book, waiting, messages[start : row_ends[i]], limits)]
        start = row_ends[i]
        values[i] = [book[name] for name in BOOK]
        left += [(one, low, high) for low, high in zip(waiting.low, waiting.high, strict=True)]
    for name, column in zip(BOOK, np.array(values, np.int64).reshape(-1, len(BOOK)).T, strict=True):
        whole = books[name].to_numpy(np.int64).copy()
        whole[codes] = column
        books[name] = whole
    found = pd.DataFrame(told, columns=REPORT)
    for name in ("skipped_from", "skipped_to", "pending_last"):
        found[name] = found[name].astype("Int64")
    return found, pd.DataFrame(left, columns=["code", "low", "high"], dtype=np.int64)


__all__ = ["BOOK", "JUMP_TO_ARRIVAL", "JUMP_TO_PENDING", "REPORT", "Overflow", "Waiting", "advance"]
