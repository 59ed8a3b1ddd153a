"""Processing-time ticks: the drained final state must equal the batch books."""

import time

from tests.model import ORDERS, replay
from tests.test_sequencing import as_messages
from tidemark.session import scratch_path
from tidemark.streaming.replay import stream_session
from tidemark.streaming.sequencer import sequence_channels


def test_ticks_drain_to_the_final_book(spark):
    cases = [order for order in ORDERS.values() if len(order) > 2]
    rows = as_messages(spark, cases)
    landing, progress = scratch_path(spark, "ticks"), scratch_path(spark, "ticks-progress")
    rows.write.parquet(landing)
    session = stream_session(spark, 2)
    ticks = sequence_channels(session.readStream.schema(rows.schema).parquet(landing), emit="tick", tick_seconds=1)
    query = (
        ticks.writeStream.format("memory").queryName("ticks").option("checkpointLocation", progress)
        .trigger(processingTime="500 milliseconds").start()
    )
    expected = {c: replay(order)[3] for c, order in enumerate(cases)}
    expected = {c: final for c, final in expected.items() if final.book != cases[c][0]}
    try:
        for _ in range(60):
            time.sleep(1)
            reports = session.table("ticks").collect()
            last = {r["channel"]: r for r in sorted(reports, key=lambda r: r["at"])}
            if all(c in last for c in expected):
                break
    finally:
        query.stop()
    for channel, final in expected.items():
        report = last[channel]
        assert (report["sequence"], report["price"], report["remaining"]) == (final.book, final.price, len(final.waiting))
    first = {r["channel"]: r for r in sorted(reports, key=lambda r: r["at"], reverse=True)}
    gap_left = cases.index(ORDERS["gap left"])
    assert [first[gap_left][name] for name in ("pending_first", "pending_last", "pending_size", "calc_from", "calc_to")] == [1, 7, 4, 1, 1]


def test_tick_overflow_skips_the_gap(spark):
    rows = as_messages(spark, [[0, 2, 3, 5]])
    landing = scratch_path(spark, "tick-overflow")
    rows.write.parquet(landing)
    session = stream_session(spark, 1)
    stream = session.readStream.schema(rows.schema).parquet(landing)
    ticks = sequence_channels(stream, emit="tick", tick_seconds=1, max_pending=1)
    query = (
        ticks.writeStream.format("memory").queryName("jumps").trigger(processingTime="300 milliseconds").start()
    )
    try:
        for _ in range(60):
            time.sleep(1)
            reports = sorted(session.table("jumps").collect(), key=lambda r: r["at"])
            if len(reports) >= 2:
                break
    finally:
        query.stop()
    first, second = reports[:2]
    assert (first["kind"], first["sequence"], first["skipped_from"], first["skipped_to"]) == ("overflow", 3, 1, 1)
    assert (first["pending_first"], first["pending_last"], first["pending_size"], first["remaining"]) == (2, 5, 3, 1)
    assert (second["kind"], second["sequence"], second["released"], second["remaining"]) == ("tick", 3, 0, 1)
