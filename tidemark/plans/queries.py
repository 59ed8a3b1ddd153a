"""Batch queries, one per operator; each takes (spark, folder of the tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import batching, routing, sequencing, windows
from tidemark.plans.inputs import (
    ORDER_COLUMNS,
    TICK_SECONDS,
    damaged_line,
    event_messages,
    holed_events,
    numbered_events,
    order_fields,
    table,
    trades,
)
from tidemark.session import scratch_path
from tidemark.sinks.copy import copy_tables
from tidemark.sinks.loads import APPEND, TRUNCATE, load_table
from tidemark.sources import csv_files, messages, tables

Query = Callable[[SparkSession, str], DataFrame]

# The launch parameters of an export job, and the literal rows of the load examples.
EXPORT_PARAMETERS = {"destDatabase": "postgres", "driver": "org.postgresql.Driver"}
FIRST_NAMES = ["Stephen", "Kamal", "Paul"]
MORE_NAMES = ["John", "Andrew", "Steve"]

# Column lists of the tables that may be copied.
COPY_COLUMNS = {
    "testdata.sf.orders": ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"],
    "testdata.sf.nation": ["n_nationkey", "n_name"],
    "testdata.sf.region": ["r_regionkey", "r_name"],
    "testdata.sf.customer": ["c_custkey", "c_name"],
    "testdata.sf.supplier": ["s_suppkey", "s_name"],
}


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column.split(".")[0] if "." in column else column)


# --- sources -----------------------------------------------------------------------------------


def scan_project(spark: SparkSession, folder: str) -> DataFrame:
    wanted = tables.columns_of(COPY_COLUMNS, "testdata.sf.orders")
    return tables.read_columns(table(spark, folder, "orders"), wanted)


def literal_rows(spark: SparkSession, folder: str) -> DataFrame:
    literals = messages.literal_rows(spark, [(name,) for name in MORE_NAMES + MORE_NAMES[:1]], "name string")
    return routing.flatten(literals, table(spark, folder, "customer").select(F.col("c_name").alias("name")))


def sequence_source(spark: SparkSession, folder: str) -> DataFrame:
    rows = messages.sequence_rows(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 1, 3, 10)
    return rows.select("o_orderkey", "n", F.concat(F.lit("number "), F.col("n").cast("string")).alias("name"), text.millis_text("ts").alias("ts"))


def message_source(spark: SparkSession, folder: str) -> DataFrame:
    return event_messages(numbered_events(spark, folder)).select(
        "event_id",
        F.decode("payload", "UTF-8").alias("payload"),
        F.col("attributes")["publishTs"].alias("publish_ts"),
        F.col("attributes")["groupKey"].alias("group_key"),
        F.col("attributes")["sequence"].alias("sequence"),
    )


def notification_paths(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("lang", "source", "n_chars")
    named = F.when(
        F.col("n_chars") >= 200, F.concat("lang", F.lit("/part-"), (F.col("n_chars") % 100).cast("string"), F.lit(".csv"))
    )
    notified = messages.with_attributes(
        documents, F.lit(""), eventType=F.lit("OBJECT_FINALIZE"), bucketId=F.col("source"), objectId=named
    )
    return messages.notification_paths(notified).select("path", "tag", "reason")


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    table(spark, folder, "documents").select("text").write.text(path)
    return csv_files.read_lines(spark, path).select(F.col("value").alias("line"))


def _orders_as_csv(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "orders-csv")
    fields = order_fields(table(spark, folder, "orders"))
    csv_files.write_lines(fields, F.concat_ws(",", *ORDER_COLUMNS), ",".join(ORDER_COLUMNS), path)
    return path


def text_lines_keyed(spark: SparkSession, folder: str) -> DataFrame:
    keyed = csv_files.keyed_lines(spark, _orders_as_csv(spark, folder), ORDER_COLUMNS)
    schema = ", ".join(f"{name} string" for name in ORDER_COLUMNS)
    return keyed.select(F.col("file_path").endswith(".csv").alias("keyed"), F.from_json("row", schema).alias("r")).select(
        "keyed", "r.*"
    )


def _documents_as_csv(spark: SparkSession, folder: str, newlines: str) -> DataFrame:
    path = scratch_path(spark, "documents-csv")
    documents = table(spark, folder, "documents")
    csv_files.write_quoted(documents, path, rows_per_file=100_000)
    rows = csv_files.read_csv(spark, path, documents.columns, csv_files.QUOTED, newlines)
    return rows.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        "lang",
        "source",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        "tag",
    )


def csv_quoted(spark: SparkSession, folder: str) -> DataFrame:
    return _documents_as_csv(spark, folder, csv_files.WHOLE_FILES)


def csv_quoted_split(spark: SparkSession, folder: str) -> DataFrame:
    return _documents_as_csv(spark, folder, csv_files.SPLIT_FILES)


def _write_damaged(spark: SparkSession, folder: str) -> str:
    """Damaged order files, one folder per order status, and one file with a header alone; their folder."""
    path = scratch_path(spark, "orders-damaged")
    fields = order_fields(table(spark, folder, "orders"))
    header = ",".join(ORDER_COLUMNS)
    csv_files.write_lines(fields, damaged_line(), header, path, partition_by=["o_orderstatus"])
    csv_files.write_lines(fields.limit(0), damaged_line(), header, f"{path}/o_orderstatus=none")
    return path


def _read_damaged(spark: SparkSession, path: str) -> DataFrame:
    return csv_files.read_csv(spark, f"{path}/*/*.csv", ORDER_COLUMNS, csv_files.STRICT, csv_files.NO_NEWLINES)


def _damaged_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _read_damaged(spark, _write_damaged(spark, folder))


def csv_strict(spark: SparkSession, folder: str) -> DataFrame:
    return routing.output(_damaged_orders(spark, folder), routing.MAIN).select(*ORDER_COLUMNS)


def csv_naive(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-naive")
    fields = order_fields(table(spark, folder, "orders"))
    last = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority"))
    line = F.concat_ws(",", *ORDER_COLUMNS[:-1], last)
    csv_files.write_lines(fields, line, ",".join(ORDER_COLUMNS), path)
    rows = csv_files.read_csv(spark, path, ORDER_COLUMNS, csv_files.NAIVE)
    return rows.select("tag", "record", "o_orderkey", "o_orderpriority")


# The columns of the two files that are written with different headers.
TWO_HEADERS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"],
    "supplier": ["s_name", "s_suppkey", "s_nationkey", "s_acctbal"],
}


def csv_json(spark: SparkSession, folder: str) -> DataFrame:
    """Two file families with different headers in one read, headers taken from the files."""
    path = scratch_path(spark, "two-headers")
    for name, columns in TWO_HEADERS.items():
        csv_files.write_quoted(_as_text(table(spark, folder, name).select(*columns)), f"{path}/{name}")
    files = csv_files.match_files(spark, f"{path}/*/*.csv")
    paths, missing = csv_files.matched_paths(files.select("path"), files)
    rows = csv_files.read_csv_json(spark, paths)
    names = [name for columns in TWO_HEADERS.values() for name in columns]
    named = F.from_json("row", ", ".join(f"{name} string" for name in names)).alias("r")
    return rows.unionByName(missing, allowMissingColumns=True).select("tag", named).select("tag", "r.*")


def _as_text(rows: DataFrame) -> DataFrame:
    """All columns as text, amounts with two places."""
    amounts = {name for name, kind in rows.dtypes if kind == "double"}
    return rows.select(*[(F.col(n).cast("decimal(18,2)") if n in amounts else F.col(n)).cast("string").alias(n) for n in rows.columns])


def ingest_notifications(spark: SparkSession, folder: str) -> DataFrame:
    """From notifications to main, trace and error rows: files named once or twice are read as often, missing ones and rows the
    formatter can't take are errors, and every file that was read is traced."""
    path = _write_damaged(spark, folder)
    files = csv_files.match_files(spark, f"{path}/*/*.csv")
    again = files.filter(F.col("path").contains("o_orderstatus=O"))
    lost = files.select(F.concat("path", F.lit(".lost")).alias("path")).filter(F.col("path").contains("o_orderstatus=P"))
    names = files.select("path").unionByName(again.select("path")).unionByName(lost)
    parts = F.regexp_extract("path", r"^(?:file:/*)?(?:([a-z0-9]+)://)?(.*)/([^/]+/[^/]+)$", 2), F.regexp_extract("path", "([^/]+/[^/]+)$", 1)
    notified = messages.with_attributes(names, F.lit(""), eventType=F.lit("OBJECT_FINALIZE"), bucketId=parts[0], objectId=parts[1])
    wanted = messages.notification_paths(notified, "/")
    rows = csv_files.read_notified(spark, f"{path}/*/*.csv", wanted, files, ORDER_COLUMNS)
    price = lambda column: F.when(column.try_cast("double") < 400000, column.try_cast("decimal(8,2)"))
    formatted = routing.format_with_capture(rows, price, "o_totalprice", "price", "price out of range")
    trace = csv_files.file_trace(formatted.filter(~F.col("reason").eqNullSafe("no such file")), files)
    told = trace.groupBy(_status("file_path").alias("status"), "step").agg(F.sum("rows").alias("rows"), F.sum("errors").alias("errors"))
    outputs = formatted.groupBy("tag", _status("file_path").alias("status"), F.regexp_extract(F.coalesce("reason", F.lit("")), "^[a-z ]*", 0).alias("why"))
    main_price = F.when(F.col("tag") == routing.MAIN, F.col("price"))
    counted = outputs.agg(F.count(F.lit(1)).alias("rows"), F.sum(main_price).cast("double").alias("price"))
    return routing.flatten(
        counted.filter("why <> 'no such file'").select("tag", "status", F.col("why").alias("what"), "rows", "price"),
        counted.filter("why = 'no such file'").select("tag", "status", F.col("why").alias("what"), F.lit(None).cast("long").alias("rows"), "price"),
        told.select(F.lit("trace").alias("tag"), "status", F.col("step").alias("what"), (F.col("rows") + F.col("errors")).alias("rows"), F.lit(None).cast("double").alias("price")),
    )


def csv_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Stray quotes, quoted line breaks, and files that end within a quoted value."""
    path = scratch_path(spark, "malformed")
    orders = order_fields(table(spark, folder, "orders")).withColumn("number", F.col("o_orderkey").cast("bigint"))
    value = (
        F.when(F.col("number") % 7 == 0, F.concat(F.lit('5"'), "o_orderpriority"))
        .when(F.col("number") % 11 == 0, F.concat(F.lit('"a ""b"",'), "o_orderpriority", F.lit('"')))
        .otherwise(F.col("o_orderpriority"))
    )
    line = F.concat_ws(",", "o_orderkey", value, "o_orderstatus")
    header = "o_orderkey,o_orderpriority,o_orderstatus"
    csv_files.write_lines(orders, line, header, f"{path}/whole")
    # Files of one record each, as text, since it has line breaks: one kind closes its quotes, the other does not.
    broken = F.concat(F.lit(header + "\n"), "o_orderkey", F.lit(',"'), "o_orderpriority", F.lit("\n\n,x"))
    for name, row, end in (("closed", 3, '",F'), ("cut", 1, "")):
        one = orders.filter(F.col("number") % 1000 == row).select(F.concat(broken, F.lit(end)).alias("value"))
        one.write.option("maxRecordsPerFile", 1).text(f"{path}/{name}")
    rows = csv_files.read_csv(spark, f"{path}/*/part*", header.split(","), csv_files.STRICT)
    return rows.select("tag", "reason", "record", *header.split(","))


# --- projections, routing ----------------------------------------------------------------------


def row_to_json(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    row = orders.select(text.row_json(orders.columns).alias("row"))
    return row.select(F.from_json("row", orders.schema).alias("r")).select("r.*")


def route_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per tag after a formatter that fails on prices of 400,000 and more."""
    rows = _damaged_orders(spark, folder)
    price = lambda column: F.when(column.try_cast("double") < 400000, column.try_cast("decimal(8,2)"))
    formatted = routing.format_with_capture(rows, price, "o_totalprice", "price", "price out of range")
    return formatted.groupBy("tag", F.regexp_extract(F.coalesce("reason", F.lit("")), "^[a-z ]*", 0).alias("why")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def _status(column: str) -> Column:
    return F.regexp_extract(column, "o_orderstatus=([A-Za-z]+)", 1)


def file_trace(spark: SparkSession, folder: str) -> DataFrame:
    """Trace rows per order status, among them those of the file without rows."""
    path = _write_damaged(spark, folder)
    traced = csv_files.file_trace(_read_damaged(spark, path), csv_files.match_files(spark, f"{path}/*/*.csv"))
    return traced.groupBy(_status("file_path").alias("status"), "step").agg(
        F.sum("rows").alias("rows"), F.sum("errors").alias("errors")
    )


def union_all(spark: SparkSession, folder: str) -> DataFrame:
    """Trace rows, one per order status and step, together with all error rows."""
    rows = _damaged_orders(spark, folder)
    steps = csv_files.file_trace(rows).select(_status("file_path").alias("status"), "step").distinct()
    trace = steps.select(F.lit("trace").alias("tag"), F.concat_ws(" ", "status", "step").alias("message"))
    error = routing.output(rows, routing.ERROR).select("tag", F.col("record").alias("message"))
    return routing.flatten(trace, error)


def key_by_attribute(spark: SparkSession, folder: str) -> DataFrame:
    keyed = messages.key_by_attribute(event_messages(holed_events(spark, folder)))
    return keyed.select("event_id", "tag", "reason", "group_key", "sequence", "publish_millis")


def key_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Messages per window and type; the key in their attributes must be the same for all of them."""
    rows = event_messages(numbered_events(spark, folder)).withColumn("key", F.col("attributes")["groupKey"])
    types = table(spark, folder, "events").select("event_id", "event_type")
    windowed = windows.assign_windows(rows.join(types, "event_id"), "ts", "1 day")
    guarded = windows.guard_single_key(windowed, ["window_start", "event_type"], "key")
    return guarded.select(text.millis_text("window_start").alias("window_start"), "event_type", "items")


def table_name_parts(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat(F.lit("testdata."), F.lower("c_mktsegment"), F.lit("."), F.replace("c_name", F.lit("#"), F.lit("_")))
    named = table(spark, folder, "customer").select(name.alias("full_name"))
    return named.select(
        "full_name",
        text.table_name_part(F.col("full_name"), 1).alias("project"),
        text.table_name_part(F.col("full_name"), 2).alias("dataset"),
        text.table_name_part(F.col("full_name"), 3).alias("table_name"),
    )


# --- windows, batches --------------------------------------------------------------------------

# Elements per list: small, so that the tables' groups have several lists.
ELEMENTS = 50
WIDTHS = {"5 seconds": 5000, "1 day": 86_400_000}


def group_output(lists: DataFrame, width: str, elements: Column) -> DataFrame:
    return lists.select(
        F.lit(width).alias("width"),
        text.millis_text("window_start").alias("window_start"),
        "group_key",
        "list_no",
        "items",
        elements.alias("event_ids"),
    )


def window_group(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("group_key")
    )
    grouped = [
        group_output(windows.group_by_window(events, "group_key", "ts", width, "event_id", ELEMENTS), width, F.col("event_id"))
        for width in WIDTHS
    ]
    return routing.flatten(*grouped)


def summary_output(summary: DataFrame) -> DataFrame:
    return summary.select(
        "group_key",
        text.millis_text("window_start").alias("window_start"),
        "list_no",
        "items",
        "group_items",
        "data_from",
        "data_to",
        "window_from",
        "window_to",
        "sequences",
        "timing",
    )


def window_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summary_output(windows.window_summary(numbered_events(spark, folder), "1 day", ELEMENTS))


def batch_output(batches: DataFrame) -> DataFrame:
    return batches.select(
        "group_key",
        text.millis_text("window_start").alias("window_start"),
        "batch_no",
        "size",
        F.concat_ws(",", F.col("items").cast("array<string>")).alias("items"),
    )


def group_into_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Events in batches per type and day."""
    events = table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("group_key")
    )
    keys = ["group_key", "window_start"]
    numbered = batching.number_batches(windows.assign_windows(events, "ts", "1 day"), keys, ["event_id"])
    return batch_output(batching.collect_batches(numbered, keys, "event_id", "event_id"))


def _manifest(names: DataFrame, keys: list[str], order: str, element: str) -> DataFrame:
    numbered = batching.number_batches(names, keys, [order])
    return batching.export_manifest(batching.collect_batches(numbered, keys, order, element), keys, EXPORT_PARAMETERS, "run1")


def export_manifest(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_mktsegment", "c_custkey", "c_name")
    manifest = _manifest(customers, ["c_mktsegment"], "c_custkey", "c_name")
    return manifest.select(
        "job_name",
        "tables",
        F.col("parameters")["destDatabase"].alias("dest_database"),
        F.col("parameters")["driver"].alias("driver"),
    )


def assign_sequence(spark: SparkSession, folder: str) -> DataFrame:
    return holed_events(spark, folder).select("event_id", "group_key", "sequence")


# --- sequencing --------------------------------------------------------------------------------


def seq_base(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.base_books(trades(spark, folder))


def seq_late(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.classify(trades(spark, folder)).select(
        "channel", "sequence", _day("arrival.at"), "arrival.l_partkey", "arrival.l_suppkey", "class"
    )


def seq_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.first_arrivals(trades(spark, folder)).select("channel", "sequence", _day("arrival.at"), "copies")


def seq_in_order(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.in_order(trades(spark, folder)).select(
        "channel", "sequence", _day("arrival.at"), _day("release.at")
    )


def seq_pending(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.pending(trades(spark, folder)).select("channel", "sequence", _day("arrival.at"))


def seq_book(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.books(trades(spark, folder))


def seq_emissions(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.emissions(trades(spark, folder)).withColumn("released_at", _day("released_at"))


def seq_ticks(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.ticks(trades(spark, folder), TICK_SECONDS)


def seq_idle_ticks(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.idle_ticks(trades(spark, folder), TICK_SECONDS)


def seq_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.gaps(trades(spark, folder))


def seq_backfill(spark: SparkSession, folder: str) -> DataFrame:
    return sequencing.backfill_ranges(trades(spark, folder))


def distinct_books(spark: SparkSession, folder: str) -> DataFrame:
    emitted = sequencing.emissions(trades(spark, folder)).select("channel", "sequence", "trade_date", "price")
    return sequencing.distinct_books(routing.flatten(emitted, emitted))


# --- tables ------------------------------------------------------------------------------------


def bind_types(spark: SparkSession, folder: str) -> DataFrame:
    return text.bind_types(table(spark, folder, "customer"))


def copied_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The tables that a manifest lists, copied to tables of the same third name, then read back as key and name.

    The manifest has one row per batch of tables; its few names are what the driver starts jobs for.
    """
    target = scratch_path(spark, "copies")
    listed = spark.createDataFrame([("all", name) for name in COPY_COLUMNS], "kind string, name string")
    manifest = _manifest(listed, ["kind"], "name", "name")
    names = [name for row in manifest.select("tables").collect() for name in row["tables"].split(",")]
    place = lambda name: f"{target}/{tables.split_table_name(name)[2]}"
    copy_tables(
        names,
        COPY_COLUMNS,
        lambda name: table(spark, folder, tables.split_table_name(name)[2]),
        lambda rows, name: text.bind_types(rows).write.parquet(place(name)),
    )
    return routing.flatten(
        *[
            spark.read.parquet(place(name)).select(
                F.lit(name).alias("source"),
                F.col(COPY_COLUMNS[name][0]).cast("string").alias("key"),
                F.col(COPY_COLUMNS[name][-1]).cast("string").alias("name"),
            )
            for name in names
        ]
    )


def new_default_table(spark: SparkSession, batches: bool = False) -> str:
    """An empty table with a defaulted column, outside any warehouse folder; on demand one partition per micro-batch."""
    name = f"default_tests_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} (id STRING, name STRING, df_ts TIMESTAMP,"
        f" date_created TIMESTAMP DEFAULT current_timestamp(){', batch BIGINT' if batches else ''})"
        f" USING parquet {'PARTITIONED BY (batch)' if batches else ''} LOCATION '{scratch_path(spark, name)}'"
    )
    return name


def stamped(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Rows for the default-column table: id and name with a fixed ``df_ts``."""
    return rows.select(
        F.col(key).cast("string").alias("id"),
        F.col(name).alias("name"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("df_ts"),
    )


def loaded_output(spark: SparkSession, name: str) -> DataFrame:
    """The loaded rows, read from the table's files; the table itself is dropped, its files stay for the reader."""
    location = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    rows = spark.read.schema(spark.table(name).schema).parquet(location)
    spark.sql(f"DROP TABLE {name}")
    return rows.select(
        "id", "name", text.millis_text("df_ts").alias("df_ts"), F.col("date_created").isNotNull().alias("created")
    )


def load_truncate(spark: SparkSession, folder: str) -> DataFrame:
    name = new_default_table(spark)
    load_table(stamped(table(spark, folder, "supplier"), "s_suppkey", "s_name"), name, APPEND)
    load_table(stamped(table(spark, folder, "customer"), "c_custkey", "c_name"), name, TRUNCATE)
    return loaded_output(spark, name)


def load_append(spark: SparkSession, folder: str) -> DataFrame:
    name = new_default_table(spark)
    literals = messages.literal_rows(spark, [(name, name) for name in FIRST_NAMES], "id string, name string")
    load_table(stamped(literals, "id", "name"), name, TRUNCATE)
    load_table(stamped(table(spark, folder, "customer"), "c_custkey", "c_name"), name, APPEND)
    load_table(stamped(table(spark, folder, "supplier"), "s_suppkey", "s_name"), name, APPEND)
    return loaded_output(spark, name)


def default_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Neither ``df_ts`` nor ``date_created`` is written: the first stays NULL, the second is filled."""
    name = new_default_table(spark)
    load_table(stamped(table(spark, folder, "customer"), "c_custkey", "c_name").drop("df_ts"), name, TRUNCATE)
    return loaded_output(spark, name)


def scalar_functions(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    fields = F.map_from_arrays(F.array(F.lit("type"), F.lit("id")), F.array("event_type", F.col("event_id").cast("string")))
    return events.select(
        "event_id",
        F.format_string("events_%d", "event_id").alias("table_name"),
        F.concat_ws(",", "event_type", F.col("user_id").cast("string")).alias("joined"),
        F.split(F.concat_ws(",", "event_type", "props"), ",")[0].alias("first_part"),
        (F.col("event_type") == "click").alias("is_click"),
        text.to_long(F.regexp_replace("props", "[^0-9]", "")).alias("k"),
        text.to_long(F.col("event_type")).alias("not_a_number"),
        F.unix_millis("ts").alias("millis"),
        text.millis_text("ts").alias("ts_text"),
        F.date_format("ts", windows.CLOCK_FORMAT).alias("clock"),
        (F.lit("0.01").cast("decimal(38,2)") * F.col("event_id").cast("decimal(20,0)")).cast("decimal(38,2)").alias("price"),
        (F.col("event_id") + 1 == F.col("user_id")).alias("follows"),
        fields["type"].alias("map_value"),
        F.get_json_object(F.to_json(fields), "$.id").alias("json_id"),
        F.decode(F.encode("props", "UTF-8"), "UTF-8").alias("decoded"),
        F.md5(F.col("event_id").cast("string").cast("binary")).alias("row_id"),
    )


BATCH: dict[str, Query] = {
    "scan_project": scan_project,
    "literal_rows": literal_rows,
    "sequence_source": sequence_source,
    "message_source": message_source,
    "notification_paths": notification_paths,
    "text_lines": text_lines,
    "text_lines_keyed": text_lines_keyed,
    "csv_quoted": csv_quoted,
    "csv_quoted_split": csv_quoted_split,
    "csv_strict": csv_strict,
    "csv_naive": csv_naive,
    "csv_json": csv_json,
    "csv_malformed": csv_malformed,
    "ingest_notifications": ingest_notifications,
    "row_to_json": row_to_json,
    "route_tags": route_tags,
    "file_trace": file_trace,
    "union_all": union_all,
    "key_by_attribute": key_by_attribute,
    "key_guard": key_guard,
    "table_name_parts": table_name_parts,
    "window_group": window_group,
    "window_summary": window_summary,
    "group_into_batches": group_into_batches,
    "export_manifest": export_manifest,
    "assign_sequence": assign_sequence,
    "seq_base": seq_base,
    "seq_late": seq_late,
    "seq_dedup": seq_dedup,
    "seq_in_order": seq_in_order,
    "seq_pending": seq_pending,
    "seq_book": seq_book,
    "seq_emissions": seq_emissions,
    "seq_ticks": seq_ticks,
    "seq_idle_ticks": seq_idle_ticks,
    "seq_gaps": seq_gaps,
    "seq_backfill": seq_backfill,
    "distinct_books": distinct_books,
    "bind_types": bind_types,
    "copy_tables": copied_tables,
    "load_truncate": load_truncate,
    "load_append": load_append,
    "default_columns": default_columns,
    "scalar_functions": scalar_functions,
}
