"""Putting sequenced messages back in order, per channel.

Input of every function: ``messages(channel, sequence BIGINT, arrival STRUCT)`` as made by
``sources.messages.sequenced``. ``arrival`` orders the messages of a channel without ties; its first
field ``at`` is the arrival time and its last field ``trade_date`` travels along.

Rules. The first arrival of a channel sets the base book and is no trade. A message whose sequence is
not above the book at its arrival is late and dropped. Others wait until every sequence between the
book and them has arrived; the book then advances through the contiguous run, one price step each.

Rows without channel, sequence or arrival time are no messages: every function leaves them out, and
``rejected`` has them with the reason. Of rows equal in channel, sequence and arrival one is the first and
the others are its copies.

A channel may hold any share of the table, and its sequences may lie close or far apart, so nothing is windowed over a channel
or over a span of sequences: copies are combined before the first shuffle, the distinct messages are dealt out in order of
(channel, sequence) by ranges of about equal numbers of rows, and windowed inside a range. What a range says of a channel is one
row (lowest and highest sequence, first arrival, first gap, latest arrival); these rows combine along the channel, at most one for each
range. There is one plan for tables of any size.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import ranges, search
from tidemark.operators.ranges import RANGE
from tidemark.operators.routing import ERROR
from tidemark.session import scratch_path

PRICE_TYPE = "decimal(38,2)"
PRICE_STEP = Decimal("0.01")


def _problem() -> Column:
    return (
        F.when(F.col("channel").isNull(), "no channel")
        .when(F.col("sequence").isNull(), "no sequence")
        .when(F.col("arrival.at").isNull(), "no arrival time")
    )


def known_messages(messages: DataFrame) -> DataFrame:
    """The rows that have all that a message needs."""
    return messages.filter(_problem().isNull())


def rejected(messages: DataFrame) -> DataFrame:
    """The rows that are no messages, as an error output."""
    return messages.withColumn("reason", _problem()).filter("reason is not null").withColumn("tag", F.lit(ERROR))


def base_books(messages: DataFrame) -> DataFrame:
    """First arrival per channel: channel, sequence, trade_date, price 0."""
    first = known_messages(messages).groupBy("channel").agg(F.min(F.struct("arrival", "sequence")).alias("first"))
    return first.select(
        "channel",
        F.col("first.sequence").alias("sequence"),
        F.col("first.arrival.trade_date").alias("trade_date"),
        F.lit(0).cast(PRICE_TYPE).alias("price"),
    )


def first_arrivals(messages: DataFrame) -> DataFrame:
    """One row per (channel, sequence): the first arrival, and how many copies came."""
    return known_messages(messages).groupBy("channel", "sequence").agg(
        F.min("arrival").alias("arrival"), F.count(F.lit(1)).alias("copies")
    )


def _placed(messages: DataFrame, parts: int | None) -> DataFrame:
    """The distinct messages with ``copies`` by range, written."""
    return ranges.dealt(first_arrivals(messages), ["channel"], ["sequence"], parts)


def _in_ranges(messages: DataFrame, parts: int | None) -> DataFrame:
    """The distinct messages by range, with what is known of them inside it."""
    return _inside(_placed(messages, parts).drop("copies"))


def _inside(placed: DataFrame) -> DataFrame:
    """Placed messages with what is known of them inside their range.

    ``first`` is the earliest (arrival, sequence) of the channel in the range, ``next`` the following sequence, ``number`` counts from 0, ``latest`` the latest
    arrival so far, and ``latest_after`` that of the rows above ``first``.
    """
    here = Window.partitionBy("channel", RANGE)
    in_order = here.orderBy("sequence")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("first", F.min(F.struct("arrival", "sequence")).over(here))
    above = F.when(F.col("sequence") > F.col("first.sequence"), F.col("arrival"))
    return placed.withColumns(
        {
            "next": F.lead("sequence").over(in_order),
            "number": (F.row_number().over(in_order) - 1).cast("bigint"),
            "latest": F.max("arrival").over(so_far),
            "latest_after": F.max(above).over(so_far),
        }
    )


def _gap_after() -> Column:
    """The sequence, where its successor is missing although a later one is there."""
    return F.when(F.col("next") > F.col("sequence") + 1, F.col("sequence"))


def _runs(rows: DataFrame) -> DataFrame:
    """One row per channel and range: ``base``, ``run_end``, ``next_low``, ``earlier_latest`` and ``earlier_rows``, combined along the channel.

    A range says two things of itself: where its first gap is and how late its arrivals are, from its lowest sequence on, which counts if the
    base lies in an earlier range, and from its own first arrival on, which counts if that is the base. A range without a gap hands the
    run on to the next, if that begins with the following sequence.
    """
    after = F.col("sequence") >= F.col("first.sequence")
    summary = rows.groupBy("channel", RANGE).agg(
        F.min("sequence").alias("low"),
        F.max("sequence").alias("high"),
        F.min("first").alias("first"),
        F.min(_gap_after()).alias("gap"),
        F.min(F.when(after, _gap_after())).alias("gap_after"),
        F.max("arrival").alias("latest"),
        F.max("latest_after").alias("latest_after"),
        F.count(F.lit(1)).alias("rows"),
    )
    channel = Window.partitionBy("channel")
    along = channel.orderBy(RANGE)
    based = summary.withColumns(
        {"base": F.min("first").over(channel), "next_low": F.lead("low").over(along), "ranges": F.count(F.lit(1)).over(channel)}
    )
    is_base = F.col("first").eqNullSafe(F.col("base"))
    later = F.col("low") > F.col("base.sequence")
    ends = F.col("next_low").isNull() | (F.col("next_low") > F.col("high") + 1)
    gap = F.when(is_base, F.col("gap_after")).when(later, F.col("gap"))
    stop = F.coalesce(gap, F.when((is_base | later) & ends, F.col("high")))
    latest = F.when(is_base, F.col("latest_after")).when(later, F.col("latest"))
    return (
        based.withColumns({"stop": stop, "run_latest": latest})
        .withColumns(
            {
                "run_end": F.min("stop").over(channel),
                "earlier_latest": F.max("run_latest").over(along.rowsBetween(Window.unboundedPreceding, -1)),
                "earlier_rows": F.sum("rows").over(along.rowsBetween(Window.unboundedPreceding, -1)),
            }
        )
        .select("channel", RANGE, "base", "run_end", "next_low", "earlier_latest", "earlier_rows", "high", "ranges")
    )


def _with_runs(rows: DataFrame) -> DataFrame:
    """The rows with ``base``, ``base_arrival``, ``run_end``, ``next``, also that of another range, ``number`` in the channel and ``run_latest``.

    A channel that lies in one range has all of it there. Only the first and the last channel of a range can lie in others too, so
    that at most two rows per range are sent to the tasks.
    """
    here = Window.partitionBy("channel", RANGE)
    stop = F.when(
        (F.col("sequence") >= F.col("first.sequence")) & (F.col("next").isNull() | _gap_after().isNotNull()), F.col("sequence")
    )
    spread = _runs(rows).filter("ranges > 1").select(
        *[F.col(name).alias(f"_across_{name}") for name in ("channel", RANGE, "base", "run_end", "next_low", "earlier_latest", "earlier_rows")]
    )
    own = rows.withColumn("own_end", F.min(stop).over(here))
    joined = own.join(F.broadcast(spread), ranges.same(["channel", RANGE], "_across_"), "left")
    base = F.coalesce("_across_base", "first")
    return joined.select(
        "channel",
        "sequence",
        "arrival",
        base["sequence"].alias("base"),
        base["arrival"].alias("base_arrival"),
        F.coalesce("_across_run_end", "own_end").alias("run_end"),
        F.coalesce("next", "_across_next_low").alias("next"),
        (F.col("number") + F.coalesce("_across_earlier_rows", F.lit(0))).alias("number"),
        F.greatest(
            "_across_earlier_latest", F.when(F.col("first").eqNullSafe(base), F.col("latest_after")).otherwise(F.col("latest"))
        ).alias("run_latest"),
    )


def ordered_messages(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """Distinct messages with ``base``, ``base_arrival``, ``run_end``, ``next``, ``release`` and ``number``.

    ``run_end`` is the last sequence of the contiguous run after the base. ``release`` is, for rows of
    that run, the arrival that completes the run up to the row, i.e. the latest arrival among the
    run's rows so far; NULL for all other rows. ``number`` counts the channel's distinct sequences from 0. ``parts`` is the number of ranges, by default that of the shuffle partitions.
    """
    return _released(_in_ranges(messages, parts))


def _released(rows: DataFrame) -> DataFrame:
    in_run = (F.col("sequence") > F.col("base")) & (F.col("sequence") <= F.col("run_end"))
    return _with_runs(rows).select(
        "channel",
        "sequence",
        "arrival",
        "base",
        "base_arrival",
        "run_end",
        "next",
        F.when(in_run, F.col("run_latest")).alias("release"),
        "number",
    )


def in_order(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """The trades the book has advanced through."""
    return ordered_messages(messages, parts).filter(F.col("release").isNotNull())


def _run_ends(messages: DataFrame, parts: int | None) -> DataFrame:
    """Per channel: base, base_arrival, run_end, last (highest present sequence)."""
    return _runs(_in_ranges(messages, parts)).groupBy("channel").agg(
        F.min("base.sequence").alias("base"),
        F.min("base.arrival").alias("base_arrival"),
        F.min("run_end").alias("run_end"),
        F.max("high").alias("last"),
    )


def pending(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """Distinct messages beyond the first gap."""
    return ordered_messages(messages, parts).filter(F.col("sequence") > F.col("run_end"))


def _price(count: Column, step: Decimal) -> Column:
    return (F.lit(step).cast(PRICE_TYPE) * count.cast("decimal(20,0)")).cast(PRICE_TYPE)


def books(messages: DataFrame, step: Decimal = PRICE_STEP, parts: int | None = None) -> DataFrame:
    """The final book of every channel."""
    return _run_ends(messages, parts).select(
        "channel",
        F.col("run_end").alias("sequence"),
        F.col("base_arrival.trade_date").alias("trade_date"),
        _price(F.col("run_end") - F.col("base"), step).alias("price"),
    )


def emissions(messages: DataFrame, step: Decimal = PRICE_STEP, parts: int | None = None) -> DataFrame:
    """One book per arrival that releases at least one trade."""
    released = in_order(messages, parts).groupBy("channel", "release").agg(
        F.max("sequence").alias("sequence"),
        F.count(F.lit(1)).alias("released"),
        F.min("base").alias("base"),
        F.min("base_arrival").alias("base_arrival"),
    )
    return released.select(
        "channel",
        "sequence",
        F.col("base_arrival.trade_date").alias("trade_date"),
        _price(F.col("sequence") - F.col("base"), step).alias("price"),
        "released",
        F.col("release.at").alias("released_at"),
    )


def classify(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """Every arrival with its class: base, in_order, pending, duplicate or late.

    First arrivals are classed where they were put in order; only the messages of sequences that came more than once are looked up, so
    that all others move no further. A (channel, sequence) with very many copies is one that the adaptive join may split.
    """
    spark, key = messages.sparkSession, ["channel", "sequence"]
    placed = _placed(messages, parts)
    # Written, as Spark then knows how few they are.
    path = scratch_path(spark, "repeated")
    placed.filter("copies > 1").select(*key).write.parquet(path)
    repeated = spark.read.schema(placed.select(*key).schema).parquet(path)
    firsts = _released(_inside(placed.drop("copies"))).select(
        *key,
        "arrival",
        F.when(F.col("sequence") == F.col("base"), "base")
        .when(F.col("sequence") < F.col("base"), "late")
        .when(F.col("release").isNotNull(), "in_order")
        .otherwise("pending")
        .alias("class"),
        "release",
    )
    path = scratch_path(spark, "firsts")
    firsts.write.parquet(path)
    firsts = spark.read.schema(firsts.schema).parquet(path)
    copy = F.row_number().over(Window.partitionBy(*key, "arrival").orderBy(F.lit(0)))
    again = known_messages(messages).select(*key, "arrival").join(repeated, key, "left_semi").withColumn("copy", copy)
    lookup = firsts.join(repeated, key, "left_semi").withColumnsRenamed({"arrival": "first_arrival", "class": "first_class"})
    others = again.join(lookup, key).filter((F.col("arrival") != F.col("first_arrival")) | (F.col("copy") > 1))
    is_late = F.col("first_class").isin("base", "late") | (F.col("release") < F.col("arrival"))
    return firsts.select(*key, "arrival", "class").union(
        others.select(*key, "arrival", F.when(is_late, "late").otherwise("duplicate").alias("class"))
    )


def gaps(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """Missing ranges after the base, below the highest present sequence."""
    return (
        ordered_messages(messages, parts)
        .filter((F.col("sequence") >= F.col("base")) & (F.col("next") > F.col("sequence") + 1))
        .select(
            "channel",
            (F.col("sequence") + 1).alias("gap_from"),
            (F.col("next") - 1).alias("gap_to"),
            (F.col("next") - F.col("sequence") - 1).alias("missing"),
        )
    )


def backfill_ranges(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """For channels with waiting trades, the range to fetch again: book + 1 … highest pending."""
    return (
        _run_ends(messages, parts)
        .filter(F.col("last") > F.col("run_end"))
        .select("channel", (F.col("run_end") + 1).alias("first"), F.col("last").cast("bigint").alias("last"))
    )


def _tick(at: str, start: str, seconds: int) -> Column:
    elapsed = F.unix_micros(F.col(at)) - F.unix_micros(F.col(start))
    return (F.floor(elapsed / F.lit(seconds * 1_000_000)) + 1).cast("bigint")


def _first_left(numbered: DataFrame) -> DataFrame:
    """For every tick that releases trades: the smallest sequence that still waits after it (channel, tick, first_left).

    That is the first sequence above the book that had arrived by then, a search of its own for each book.
    """
    books = (
        numbered.filter("done is not null")
        .groupBy("channel", F.col("done").alias("tick"))
        .agg(F.max("number").alias("at"))
        .withColumn("bound", F.col("tick"))
    )
    # The base and what lies below it never waits.
    came = F.when(F.col("sequence") > F.col("base"), F.col("came"))
    arrived = numbered.select("channel", "number", F.col("sequence").alias("place"), came.alias("value"))
    return search.first_within(arrived, books, ["channel"]).select("channel", "tick", F.col("place").alias("first_left"))


def ticks(messages: DataFrame, seconds: int, parts: int | None = None) -> DataFrame:
    """The report of every tick in which a new trade arrived.

    Ticks count from the channel's first arrival. ``pending_size``, ``pending_first`` and ``pending_last`` are taken
    before the tick drains, ``remaining`` and ``remaining_first`` after it.
    """
    return _reports(messages, seconds, parts).drop(RANGE)


def _reports(messages: DataFrame, seconds: int, parts: int | None) -> DataFrame:
    """The reports with their range, in order of channel and tick."""
    ordered = ordered_messages(messages, parts).select(
        "channel",
        "sequence",
        "number",
        "base",
        _tick("arrival.at", "base_arrival.at", seconds).alias("came"),
        _tick("release.at", "base_arrival.at", seconds).alias("done"),
    )
    # Written, as arrivals, releases and the search all read it.
    path = scratch_path(messages.sparkSession, "ticks")
    ordered.write.parquet(path)
    numbered = messages.sparkSession.read.schema(ordered.schema).parquet(path)
    trades = numbered.filter(F.col("sequence") > F.col("base"))
    # Arrivals and releases are summed apart, so that no row is doubled; only ticks meet.
    arrived = (
        trades.groupBy("channel", F.col("came").alias("tick"))
        .agg(
            F.count(F.lit(1)).alias("arrived"),
            F.min("sequence").alias("low"),
            F.max("sequence").alias("seen"),
            F.min("base").alias("book"),
        )
        .withColumn("calculated", F.lit(0).cast("bigint"))
    )
    nothing = F.lit(None).cast("bigint")
    released = (
        trades.filter(F.col("done").isNotNull())
        .groupBy("channel", F.col("done").alias("tick"))
        .agg(F.count(F.lit(1)).alias("calculated"), F.max("sequence").alias("book"))
        .withColumns({"arrived": F.lit(0).cast("bigint"), "low": nothing, "seen": nothing})
    )
    per_tick = (
        arrived.unionByName(released)
        .groupBy("channel", "tick")
        .agg(
            *[F.sum(name).alias(name) for name in ("arrived", "calculated")],
            *[F.max(name).alias(name) for name in ("low", "seen", "book")],
        )
        .join(_first_left(numbered), ["channel", "tick"], "left")
    )
    reports = ranges.running(
        per_tick,
        ["channel"],
        ["tick"],
        {"came": F.col("arrived"), "left": F.col("calculated")},
        {"book_sequence": F.col("book"), "pending_last": F.col("seen")},
        keep=True,
    )
    waiting = F.col("came") - F.col("left")
    released = F.col("calculated") > 0
    # While the book stays, the first waiting sequence is the least of what was left and what has come since.
    added = F.when(released, F.col("first_left")).otherwise(F.col("low"))
    # A book never falls from tick to tick, so the same ranges are in order of it.
    firsts = ranges.running(reports, ["channel", "book_sequence"], ["tick"], maxima={"_least": -added}, keep=True)
    return firsts.select(
        RANGE,
        "channel",
        "tick",
        "book_sequence",
        "arrived",
        "calculated",
        F.when(released, F.col("book") - F.col("calculated") + 1).alias("calc_from"),
        F.when(released, F.col("book")).alias("calc_to"),
        F.when(released, F.col("book") - F.col("calculated") + 1).otherwise(-F.col("_least")).alias("pending_first"),
        "pending_last",
        (waiting + F.col("calculated")).alias("pending_size"),
        waiting.alias("remaining"),
        (-F.col("_least")).alias("remaining_first"),
    )


def idle_ticks(messages: DataFrame, seconds: int, parts: int | None = None) -> DataFrame:
    """The ticks in which nothing arrives while trades wait, as ranges; one without end lasts until now."""
    reports = _reports(messages, seconds, parts).select(RANGE, "channel", "tick", "remaining", "remaining_first", "pending_last")
    nearest = ranges.running(reports, ["channel"], ["tick"], maxima={"_later": -F.col("tick")}, own=False, backward=True)
    following = -F.col("_later")
    return nearest.filter((F.col("remaining") > 0) & (following.isNull() | (following > F.col("tick") + 1))).select(
        "channel",
        (F.col("tick") + 1).alias("tick_from"),
        (following - 1).alias("tick_to"),
        F.col("remaining").alias("pending_size"),
        F.col("remaining_first").alias("pending_first"),
        "pending_last",
    )


def distinct_books(books: DataFrame) -> DataFrame:
    """Books are equal when channel, sequence, trade date and price are."""
    return books.dropDuplicates(["channel", "sequence", "trade_date", "price"])


__all__ = [
    "backfill_ranges",
    "base_books",
    "books",
    "classify",
    "distinct_books",
    "emissions",
    "first_arrivals",
    "gaps",
    "idle_ticks",
    "in_order",
    "known_messages",
    "ordered_messages",
    "pending",
    "rejected",
    "ticks",
]
