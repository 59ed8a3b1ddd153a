"""Messages with string attributes, keyed messages, and generated sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import file_path, to_long
from tidemark.operators.ranges import number_rows
from tidemark.operators.routing import route


def with_attributes(df: DataFrame, payload: Column, **attributes: Column) -> DataFrame:
    """Add ``payload`` (binary) and ``attributes`` (text to text)."""
    pairs = [part for name, value in attributes.items() for part in (F.lit(name), value.cast("string"))]
    return df.withColumn("payload", payload.cast("binary")).withColumn("attributes", F.create_map(*pairs))


def from_broker_records(df: DataFrame) -> DataFrame:
    """Broker records (value, headers, timestamp), batch or stream, as payload, attributes and ts."""
    headers = F.map_from_entries(
        F.transform("headers", lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
    )
    return df.select(F.col("value").alias("payload"), headers.alias("attributes"), F.col("timestamp").alias("ts"))


def key_by_attribute(messages: DataFrame) -> DataFrame:
    """Add ``group_key``, ``sequence`` and ``publish_millis`` from the attributes, and route bad rows.

    A missing key, or a sequence or time that is no number, sends the row to the error output.
    """
    parsed = (
        messages.withColumn("group_key", F.col("attributes")["groupKey"])
        .withColumn("sequence", to_long(F.col("attributes")["sequence"]))
        .withColumn("publish_millis", to_long(F.col("attributes")["publishTs"]))
    )
    problem = (
        F.when(F.col("group_key").isNull(), "no groupKey")
        .when(F.col("sequence").isNull(), "sequence is not a number")
        .when(F.col("publish_millis").isNull(), "publishTs is not a number")
    )
    return route(parsed, problem)


def sequenced(
    df: DataFrame, channel: Column, sequence: Column, at: Column, ties: Sequence[str], trade_date: Column
) -> DataFrame:
    """The input of ``operators.sequencing``: channel, sequence, arrival.

    ``at`` is the arrival time, ``ties`` the columns that order equal times.
    """
    arrival = F.struct(
        at.cast("timestamp").alias("at"), *[F.col(name) for name in ties], trade_date.cast("bigint").alias("trade_date")
    )
    return df.select(channel.alias("channel"), sequence.cast("bigint").alias("sequence"), arrival.alias("arrival"))


def assign_sequence(df: DataFrame, group: str, ts: str, tie: str) -> DataFrame:
    """Add ``sequence``: 0, 1, 2, … per group in send order (``ts``, then the integer ``tie``).

    Rows without group are numbered as a group of their own, those without time first. Bursts and groups of any size are cut by
    number of rows (see ``operators.ranges``).
    """
    return number_rows(df, [group], [ts, tie], "sequence")


def sequence_rows(df: DataFrame, order: Sequence[str], start: int, per_period: int = 20, period_seconds: int = 1) -> DataFrame:
    """Add ``n``, the rows' longs from ``start`` in ``order``, and ``ts``, ``per_period`` of them every ``period_seconds`` from the epoch."""
    numbered = number_rows(df.withColumn("_all", F.lit(0)), ["_all"], order, "n")
    step = F.floor(F.col("n") / F.lit(per_period)).cast("bigint") * F.lit(period_seconds)
    return numbered.select(*df.columns, (F.col("n") + start).alias("n"), F.timestamp_seconds(step).alias("ts"))


def sequence_stream(
    spark: SparkSession, start: int, per_period: int = 20, period_seconds: int = 1, start_millis: int = 0
) -> DataFrame:
    """The unbounded form: one micro-batch of ``per_period`` values per period of event time."""
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", per_period)
        .option("advanceMillisPerBatch", period_seconds * 1000)
        .option("startTimestamp", start_millis)
        .load()
        .select((F.col("value") + F.lit(start)).alias("n"), F.col("timestamp").alias("ts"))
    )


def literal_rows(spark: SparkSession, values: Sequence[tuple], schema: str) -> DataFrame:
    """Rows given in the program, duplicates kept."""
    return spark.createDataFrame(list(values), schema)


def notification_paths(notifications: DataFrame, scheme: str = "gs://") -> DataFrame:
    """Add the ``path`` a file notification points to; a missing attribute routes it to the error output.

    Every event type counts and a path named twice stays twice.
    """
    bucket, name = F.col("attributes")["bucketId"], F.col("attributes")["objectId"]
    problem = F.when(bucket.isNull(), "no bucketId").when(name.isNull(), "no objectId")
    return route(notifications.withColumn("path", file_path(bucket, name, scheme)), problem)
