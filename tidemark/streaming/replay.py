"""Running a streaming query over a table, slice by slice in time order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.session import scratch_path

ROWS_PER_SLICE = 100_000_000
KEY_ROWS_PER_SLICE = 1_000_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for stateful queries: RocksDB state, one state partition per core."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.shuffle.partitions", state_partitions or spark.sparkContext.defaultParallelism)
    return session


def slice_count(df: DataFrame, key: str, at_least: int = 3) -> int:
    """Slices needed to keep one micro-batch, and one key's rows in it, within what tasks can take.

    A keyed stateful operator handles the rows of one key in one task, so a key with a large share of the
    table asks for more slices.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    rows, largest = per_key.agg(F.sum("rows"), F.max("rows")).first()
    return max(at_least, -(-(rows or 0) // ROWS_PER_SLICE), -(-(largest or 0) // KEY_ROWS_PER_SLICE))


def time_slices(df: DataFrame, ts: str, count: int) -> list[DataFrame]:
    """The rows cut into ``count`` slices of about equal numbers of rows, in order of time; rows of one instant stay together.

    The rows are written once, by slice, so that what made them is not repeated for every slice. Slices that bursts leave empty are
    left out, and there is always one.
    """
    micros = F.unix_micros(F.col(ts))
    shares = [number / count for number in range(1, count)]
    found = df.agg(F.percentile_approx(micros, shares, 100 * count)).first()[0] if shares else None
    edges = sorted(set(found or []))
    passed = F.size(F.filter(F.array(*[F.lit(edge).cast("bigint") for edge in edges]), lambda edge: edge < micros)) if edges else F.lit(0)
    path = scratch_path(df.sparkSession, "slices")
    df.withColumn("_slice", F.coalesce(passed, F.lit(0)).cast("int")).repartitionByRange("_slice", ts).write.partitionBy("_slice").parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("_slice", T.IntegerType())])
    written = df.sparkSession.read.schema(schema).parquet(path)
    numbers = sorted(row["_slice"] for row in written.select("_slice").distinct().collect())
    return [written.filter(F.col("_slice") == number).drop("_slice") for number in numbers or [0]]


def run_slices(
    spark: SparkSession, slices: list[DataFrame], write: Callable[[DataFrame], DataStreamWriter], name: str
) -> None:
    """Land one slice after the other and let the query take in each before the next arrives.

    ``write`` turns the streaming rows into a writer; its checkpoint and trigger are set here. A slice is
    complete before the query sees it, so rows cannot overtake those of an earlier slice.
    """
    landing, progress = scratch_path(spark, f"{name}-landing"), scratch_path(spark, f"{name}-progress")
    session = stream_session(spark)
    schema = slices[0].schema
    for part in slices:
        part.write.mode("append").parquet(landing)
        writer = write(session.readStream.schema(schema).parquet(landing))
        writer.option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()


def run_to_table(
    spark: SparkSession, slices: list[DataFrame], transform: Callable[[DataFrame], DataFrame], name: str
) -> DataFrame:
    """``run_slices`` into an append-only parquet table; its rows."""
    out = scratch_path(spark, f"{name}-out")
    schemas = []

    def write(stream: DataFrame) -> DataStreamWriter:
        result = transform(stream)
        schemas.append(result.schema)
        return result.writeStream.queryName(name).outputMode("append").format("parquet").option("path", out)

    run_slices(spark, slices, write, name)
    return spark.read.schema(schemas[-1]).parquet(out)
