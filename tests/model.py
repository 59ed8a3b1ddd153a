"""The sequencing rules one message at a time, as the tests' measure for the DataFrame and stream forms."""

from __future__ import annotations

from decimal import Decimal


class Channel:
    def __init__(self, max_pending=None, on_overflow="arrival", step=Decimal("0.01")):
        self.book = None
        self.price = Decimal(0)
        self.waiting: set[int] = set()
        self.max_pending = max_pending
        self.on_overflow = on_overflow
        self.step = step

    def _drain(self) -> list[int]:
        run = []
        while self.book + 1 in self.waiting:
            self.book += 1
            self.waiting.remove(self.book)
            self.price += self.step
            run.append(self.book)
        return run

    def arrive(self, sequence: int):
        """Class of the arrival and what it emits: (kind, book, price, released, skipped range)."""
        if self.book is None:
            self.book = sequence
            return "base", None
        if sequence <= self.book:
            return "late", None
        if sequence in self.waiting:
            return "duplicate", None
        before = len(self.waiting)
        self.waiting.add(sequence)
        run = self._drain()
        if run:
            return "new", ("book", self.book, self.price, len(run), None)
        if self.max_pending is not None and before > self.max_pending:
            old = self.book
            if self.on_overflow == "arrival":
                self.waiting.clear()
                self.book, self.price = sequence, self.price + self.step
                return "new", ("overflow", self.book, self.price, 1, (old + 1, sequence - 1))
            first = min(self.waiting)
            self.book = first - 1
            run = self._drain()
            return "new", ("overflow", self.book, self.price, len(run), (old + 1, first - 1))
        return "new", None


def replay(sequences, **options):
    """Classes, emissions and the final channel for one arrival order."""
    channel = Channel(**options)
    classes, emitted, drained_at, arrived = [], [], {}, {}
    for position, sequence in enumerate(sequences):
        before = channel.book
        kind, event = channel.arrive(sequence)
        classes.append(kind)
        if kind == "new":
            arrived[sequence] = position
        if event:
            emitted.append((position, *event))
            for done in range(before + 1, channel.book + 1):
                drained_at[done] = position
    final = ["in_order" if kind == "new" and sequences[i] in drained_at else "pending" if kind == "new" else kind
             for i, kind in enumerate(classes)]
    return final, emitted, drained_at, channel


# Arrival orders worth naming: gap, duplicate, late, first arrival not the smallest, late duplicate of a
# released sequence, long jump, negative sequences, block borders.
ORDERS = {
    "in order": [0, 1, 2, 3],
    "gap closed late": [0, 2, 3, 5, 1, 4],
    "gap left": [0, 1, 3, 4, 7],
    "duplicates": [5, 6, 6, 8, 8, 7, 8, 9],
    "late": [3, 1, 2, 4, 3, 5],
    "base not smallest": [10, 4, 11, 9, 12],
    "single": [42],
    "same again": [7, 7, 7],
    "far apart": [1, 2_000_000, 2, 2_000_001, 3],
    "negative": [-3, -2, 0, -1, 1, 2],
    "block border": [1022, 1024, 1025, 1023, 2047, 2048, 1026],
    "backwards": [0, 6, 5, 4, 3, 2, 1],
}
