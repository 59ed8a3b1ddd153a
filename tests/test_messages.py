import datetime as dt

from pyspark.sql import functions as F

from tidemark.sources import messages


def test_bad_attributes_go_to_the_error_output(spark):
    attributes = [
        {"groupKey": "g", "sequence": "7", "publishTs": "1700000000000"},
        {"sequence": "7", "publishTs": "1"},
        {"groupKey": "g", "sequence": "x", "publishTs": "1"},
        {"groupKey": "g", "sequence": "1"},
    ]
    rows = messages.key_by_attribute(spark.createDataFrame([(a,) for a in attributes], "attributes map<string,string>"))
    assert [tuple(r) for r in rows.select("group_key", "sequence", "tag", "reason").collect()] == [
        ("g", 7, "main", None),
        (None, 7, "error", "no groupKey"),
        ("g", None, "error", "sequence is not a number"),
        ("g", 1, "error", "publishTs is not a number"),
    ]


def test_broker_records(spark):
    schema = "value binary, headers array<struct<key:string,value:binary>>, timestamp timestamp"
    rows = spark.createDataFrame([(b"p", [("groupKey", b"g")], dt.datetime(2024, 1, 1))], schema)
    row = messages.from_broker_records(rows).first()
    assert bytes(row["payload"]) == b"p" and row["attributes"] == {"groupKey": "g"}


def test_sequence_rows(spark):
    rows = messages.sequence_rows(spark.range(7).select((F.col("id") * -1).alias("key")), ["key"], 5, 3, 10).orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(5, 12))
    assert [r["key"] for r in rows] == list(range(-6, 1))
    assert [int(r["ts"].timestamp()) for r in rows] == [0, 0, 0, 10, 10, 10, 20]


def test_sequence_stream(spark, tmp_path):
    stream = messages.sequence_stream(spark, 1, 3, 10)
    query = stream.writeStream.format("memory").queryName("numbers").trigger(processingTime="100 milliseconds").start()
    try:
        for _ in range(100):
            query.awaitTermination(0.2)
            if spark.table("numbers").count() >= 6:
                break
    finally:
        query.stop()
    rows = sorted((r["n"], int(r["ts"].timestamp())) for r in spark.table("numbers").collect())[:6]
    assert rows == [(1, 0), (2, 0), (3, 0), (4, 10), (5, 10), (6, 10)]


def test_assign_sequence_keeps_rows_without_group_or_time(spark):
    group = F.when(F.col("id") % 3 > 0, F.col("id") % 3)
    rows = spark.range(60).select(group.alias("g"), F.when(F.col("id") > 2, F.timestamp_seconds(F.col("id") / 2)).alias("ts"), "id")
    numbered = messages.assign_sequence(rows, "g", "ts", "id")
    assert numbered.filter("sequence <> id div 3").count() == 0 and numbered.count() == 60
