import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tidemark.functions.text import bind_types
from tidemark.operators.routing import tap
from tidemark.plans.queries import new_default_table
from tidemark.session import scratch_path, shared_folder
from tidemark.sinks.copy import copy_tables
from tidemark.sinks.database import append_to_database, target_table
from tidemark.sinks.loads import load_table
from tidemark.sources.tables import columns_of, split_table_name
from tidemark.streaming.loads import start_loads


def test_unlisted_table_is_an_error():
    with pytest.raises(ValueError, match="no column list"):
        columns_of({"a.b.c": ["x"]}, "a.b.d")
    with pytest.raises(ValueError, match="project.dataset.table"):
        split_table_name("a.b")


def test_loads_never_create_their_target(spark):
    with pytest.raises(ValueError, match="does not exist"):
        load_table(spark.range(1), "no_such_table")


def test_unknown_column_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)column"):
        load_table(spark.range(1).select(F.lit("a").alias("other")), new_default_table(spark))


def test_defaults_and_nulls(spark):
    name = new_default_table(spark)
    load_table(spark.createDataFrame([("1", "a")], "id string, name string"), name)
    load_table(spark.createDataFrame([("2", "b", dt.datetime(2024, 1, 1))], "id string, name string, df_ts timestamp"), name)
    rows = {r["id"]: r for r in spark.table(name).collect()}
    assert rows["1"]["df_ts"] is None and rows["1"]["date_created"] is not None
    assert rows["2"]["df_ts"] == dt.datetime(2024, 1, 1)
    load_table(spark.createDataFrame([("3", "c")], "id string, name string"), name, "truncate")
    assert [r["id"] for r in spark.table(name).collect()] == ["3"]


def test_bind_types(spark):
    frame = spark.sql("select 1 i, 2L l, cast(1.5 as float) f, 2.5D d, true b, date'2024-01-01' t, 1.20BD n, cast(null as bigint) z")
    bound = bind_types(frame)
    assert [f.dataType.simpleString() for f in bound.schema] == ["int", "string", "float", "double", "boolean", "string", "string", "string"]
    assert tuple(bound.first()) == (1, "2", 1.5, 2.5, True, "2024-01-01", "1.20", None)


def test_database_append(spark, monkeypatch):
    """What reaches Spark's JDBC writer; no database is started."""
    seen = {}

    def jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, properties=properties)

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    append_to_database(spark.range(3), "p.d.games", "target", "jdbc:postgresql://host/db", {"driver": "d"})
    assert seen == {"url": "jdbc:postgresql://host/db", "table": "target.games", "mode": "append", "properties": {"driver": "d"}}
    assert target_table("db", "a.b.c") == "db.c"


def test_copy_checks_all_names_first(spark):
    written = []
    lists = {"a.b.one": ["id"], "a.b.two": ["id"]}
    read = lambda name: spark.range(4 if name.endswith("one") else 6)

    def write(frame, name):
        written.append(name)
        frame.write.format("noop").mode("overwrite").save()

    with pytest.raises(ValueError):
        copy_tables(["a.b.one", "a.b.other"], lists, read, write)
    assert written == []
    assert copy_tables(list(lists), lists, read, write) == {"a.b.one": 4, "a.b.two": 6}


def test_tap_counts_and_passes_on(spark):
    seen = Observation()
    assert tap(spark.range(5), seen, top=F.max("id")).count() == 5
    assert seen.get == {"rows": 5, "top": 4}


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_periodic_loads(spark):
    landing, name = scratch_path(spark, "periodic"), new_default_table(spark)
    write = lambda n: spark.range(n, n + 2).select(F.col("id").cast("string")).write.mode("append").parquet(landing)
    write(0)
    query = start_loads(spark.readStream.schema("id string").parquet(landing), name, scratch_path(spark, "p"), "1 second")
    try:
        query.processAllAvailable()
        write(2)
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.table(name).collect()
    assert sorted(row["id"] for row in rows) == ["0", "1", "2", "3"]
    assert all(row["date_created"] is not None and row["name"] is None for row in rows)
    with pytest.raises(ValueError, match="does not exist"):
        start_loads(spark.readStream.schema("id string").parquet(landing), "no_such_table", scratch_path(spark, "p"))


def test_repeated_micro_batch_replaces_its_load(spark):
    name = new_default_table(spark, batches=True)
    first = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string")
    load_table(first, name, "truncate", {"batch": 0})
    load_table(spark.createDataFrame([("3", "c")], "id string, name string"), name, "truncate", {"batch": 1})
    load_table(first, name, "truncate", {"batch": 0})
    rows = spark.table(name).collect()
    assert sorted((r["id"], r["batch"]) for r in rows) == [("1", 0), ("2", 0), ("3", 1)]
    assert all(r["date_created"] is not None for r in rows)
