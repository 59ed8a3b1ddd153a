"""The tables as the inputs of the operators: messages, sequenced trades, CSV lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.messages import assign_sequence, sequenced, with_attributes
from tidemark.sources.tables import load

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
TICK_SECONDS = 30 * 24 * 3600


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table, its zone-less timestamps read as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return load(spark, folder, name)


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """Lineitem as sequenced messages: orders are channels, line numbers sequences, ship dates arrivals."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("at")
    )
    return sequenced(
        rows, F.col("l_orderkey"), F.col("l_linenumber"), F.col("at"), ["l_partkey", "l_suppkey"], F.unix_millis("at")
    )


def numbered_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with ``ts`` as timestamp, ``group_key`` and the send ``sequence`` of their type."""
    rows = table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("group_key"), "props"
    )
    return assign_sequence(rows, "group_key", "ts", "event_id")


def holed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of which some have lost their type, numbered per type; those without are numbered together."""
    rows = table(spark, folder, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        F.when(F.col("event_id") % 37 > 0, F.col("event_type")).alias("group_key"),
        "props",
    )
    return assign_sequence(rows, "group_key", "ts", "event_id")


def event_messages(events: DataFrame) -> DataFrame:
    """Numbered events as messages with payload and attributes; some have no time among them."""
    return with_attributes(
        events,
        F.col("props"),
        publishTs=F.when(F.col("event_id") % 41 > 0, F.unix_millis("ts")),
        groupKey=F.col("group_key"),
        sequence=F.col("sequence"),
    )


def order_fields(orders: DataFrame) -> DataFrame:
    """Orders with all columns as text."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


def damaged_line() -> Column:
    """Order lines, every 10th cut to four fields and every 15th of the others one field too long."""
    number = F.col("o_orderkey").cast("bigint")
    return (
        F.when(number % 10 == 0, F.concat_ws(",", *ORDER_COLUMNS[:4]))
        .when(number % 15 == 0, F.concat_ws(",", *ORDER_COLUMNS, F.lit("extra")))
        .otherwise(F.concat_ws(",", *ORDER_COLUMNS))
    )
