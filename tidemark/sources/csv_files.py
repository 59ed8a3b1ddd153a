"""CSV files to string rows, with main and error rows of every file.

Three reading modes, all on Spark's own readers:

* ``quoted``  quotes and embedded newlines honoured, blank lines skipped; a short row keeps the columns it
  has (the missing ones are NULL, empty ones ""), extra values are ignored;
* ``strict``  as quoted, but a row shorter than the header goes to the error output;
* ``naive``   every line is cut at each comma, no quoting; a line that is short after its trailing empty
  fields are dropped, blank lines included, goes to the error output or fails the query.

A quote opens a value only at the start of a field; anywhere else it is a character. A record whose quote is never
closed goes to the error output, whatever the mode, and where files are read in splits so does one above ``RECORD_LIMIT`` characters.

The quoting modes take one of three ways with newlines inside values:

* ``SPLIT_FILES``  the default: files of any size are read in splits, and the records are put together by the state that
  each line leaves the next in, at the price of a shuffle;
* ``NO_NEWLINES``  there are none; Spark's reader splits the files, so this is the way to choose where possible;
* ``WHOLE_FILES``  one file is one task of Spark's reader, for files known to be well formed and of moderate size.
"""

from __future__ import annotations

import csv
from collections import Counter, defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import row_json
from tidemark.operators.routing import ERROR, MAIN, flatten, route

QUOTED, STRICT, NAIVE = "quoted", "strict", "naive"
NO_NEWLINES, WHOLE_FILES, SPLIT_FILES = "no newlines", "whole files", "split files"
OUTSIDE, INSIDE = 0, 1
#: Characters of the longest record; one above is an error row with what the limit leaves of it.
RECORD_LIMIT = 1 << 24
_RECORD = "_record"
_OUTPUT = ("file_path", "tag", "reason", "record")


def match_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Path and length of every file of a glob; contents are not read."""
    return spark.read.format("binaryFile").load(pattern).select("path", "length")


def matched_paths(notified: DataFrame, files: DataFrame) -> tuple[list[str], DataFrame]:
    """The paths to read, each as often as it was notified, and error rows for paths without a file.

    The list has one entry per file and notification of it, which the reader's own file index on the
    driver holds anyway; rows of the files never pass the driver.
    """
    counted = notified.groupBy("path").agg(F.count(F.lit(1)).alias("times"))
    found = counted.join(files.select("path").distinct(), "path", "left_semi")
    missing = counted.join(files.select("path").distinct(), "path", "left_anti").select(
        F.col("path").alias("file_path"), F.lit(ERROR).alias("tag"), F.lit("no such file").alias("reason")
    )
    return [row["path"] for row in found.toLocalIterator() for _ in range(row["times"])], missing


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per text line: file_path, value."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file_path"), "value"
    )


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """First line of every file: file_path, header."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    return (
        lines.filter(F.col("start") == 0)
        .groupBy("file_path")
        .agg(F.min_by("value", "line").alias("header"))
    )


# A value in quotes up to its closing quote, and what a field may hold; possessive, so that no line is tried twice.
_QUOTED_VALUE = '"[^"]*+(?:""[^"]*+)*+'
_FIELD = f'(?:{_QUOTED_VALUE}"[^,]*+|[^",][^,]*+)?+'
_OPENS = f"^(?:{_FIELD},)*+{_QUOTED_VALUE}$"
_STAYS_OPEN = f'^[^"]*+(?:""[^"]*+)*+(?:$|"[^,]*+,(?:{_FIELD},)*+{_QUOTED_VALUE}$)'


def _width(record: Column) -> Column:
    """Number of fields of a raw record: commas outside quoted values plus one; a value never closed ends with the record."""
    unquoted = F.regexp_replace(record, f'(^|,){_QUOTED_VALUE}(?:"|$)', "$1")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1


def _unterminated(record: Column) -> Column:
    return F.coalesce(F.replace(record, F.lit("\n"), F.lit(" ")).rlike(_OPENS), F.lit(False))


def _present(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty fields as "", fields the row does not have as NULL; ``_fields`` is the row's width."""
    return rows.select(
        "file_path",
        "record",
        "_fields",
        "open",
        "too_long",
        *[
            F.when(F.col("_fields") > position, F.coalesce(F.col(name), F.lit(""))).alias(name)
            for position, name in enumerate(columns)
        ],
    )


def _read_quoted(spark: SparkSession, paths, columns: Sequence[str], multi_line: bool) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*columns, _RECORD]])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", _RECORD)
        .option("columnPruning", False)  # the width check needs the whole record
        .option("enforceSchema", False)
        .csv(paths if isinstance(paths, str) else list(paths))
        .withColumn("file_path", F.col("_metadata.file_path"))
    )
    # Spark refuses a scan of the raw record alone, so its expression names a data column as well.
    record = F.when(F.col(_RECORD).isNotNull(), F.coalesce(F.col(_RECORD), F.col(columns[0])))
    width = F.when(F.col("record").isNull(), F.lit(len(columns))).otherwise(_width(F.col("record")))
    sized = rows.withColumn("record", record).withColumn("_fields", width)
    return _present(sized.withColumns({"open": _unterminated(F.col("record")), "too_long": F.lit(False)}), columns)


def _then(before: Column, after_out: Column, after_in: Column) -> Column:
    return F.when(before == INSIDE, after_in).otherwise(after_out)


def _running_state(name: str, after_out: str, after_in: str, place: str, window: WindowSpec) -> dict[str, Column]:
    """What composing the functions of the rows of a window gives for either state before them: columns ``{name}_out`` and ``{name}_in``.

    A function on two states keeps the state, flips it or sets it. The composition is the last state set, flipped as often as since then; before any
    is set, it is the state itself, flipped as often.
    """
    out, in_ = F.col(after_out), F.col(after_in)
    flips = F.sum((out > in_).cast("bigint")).over(window)
    # A set state is kept as it would be before any flip of the window, so that all flips up to a later row apply to it.
    return {
        f"{name}_flips": flips,
        f"{name}_set": F.max(F.when(out == in_, F.struct(place, ((out + F.col(f"{name}_flips")) % 2).alias("state")))).over(window),
        f"{name}_out": (F.coalesce(f"{name}_set.state", F.lit(OUTSIDE)) + F.col(f"{name}_flips")) % 2,
        f"{name}_in": (F.coalesce(f"{name}_set.state", F.lit(INSIDE)) + F.col(f"{name}_flips")) % 2,
    }


def _composed(rows: DataFrame, *args) -> DataFrame:
    for name, column in _running_state(*args).items():
        rows = rows.withColumn(name, column)
    return rows


def _split_entries(stated: DataFrame) -> DataFrame:
    """One row per split: the state it is entered in, the number of its first record, and how long that already is."""
    split = ["file_path", "split"]
    last = F.max(F.struct("line", "after_out", "after_in"))
    sides = {}
    for side in ("out", "in"):
        ends = F.col(f"after_{side}") == OUTSIDE
        sides[f"ends_{side}"] = F.count_if(ends)
        sides[f"closed_{side}"] = F.coalesce(F.max(F.when(ends, F.col("upto"))), F.lit(0))
    functions = stated.groupBy(*split).agg(last.alias("last"), F.max("upto").alias("size"), *[c.alias(n) for n, c in sides.items()])
    functions = functions.withColumns({"_out": F.col("last.after_out"), "_in": F.col("last.after_in")})
    along = Window.partitionBy("file_path").orderBy("split")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    functions = _composed(functions, "left", "_out", "_in", "split", upto)
    entered = F.coalesce(F.lag("left_out").over(along), F.lit(OUTSIDE))
    entries = functions.withColumn("entry", entered).withColumns(
        {
            "ends": _then(F.col("entry"), F.col("ends_out"), F.col("ends_in")),
            "tail": F.col("size") - _then(F.col("entry"), F.col("closed_out"), F.col("closed_in")),
        }
    )
    entries = entries.withColumns(
        {
            "first_no": F.coalesce(F.sum("ends").over(before), F.lit(0)) + 1,
            "_handed": F.lag("tail").over(along),
            "_since": F.coalesce(F.count_if(F.col("ends") > 0).over(before), F.lit(0)),
        }
    )
    # What the splits since the last that ended a record hand on is the length of the open one.
    since = Window.partitionBy("file_path", "_since").orderBy("split").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.when(F.col("entry") == INSIDE, F.sum("_handed").over(since)).otherwise(0)
    return entries.select(*split, "entry", "first_no", carried.alias("carried"))


def split_records(spark: SparkSession, paths: str | Sequence[str], limit: int = RECORD_LIMIT) -> DataFrame:
    """Records of quoted files as file_path, record_no (from 1), record, open and too_long, read in splits of any file size.

    A line is a function on {outside, inside}: the state it leaves the next line in, for either state it may begin in. The functions of a split's lines are
    composed inside the split, and those of the splits along their file; that gives the state each split is entered in, the number
    of its first record and the length of what is open there. Lines move once, each split to a place of its own; the pieces of records
    that cross splits move once more. Of a record longer than ``limit`` characters only the lines that begin before the limit are kept, and it is
    ``too_long``: a quote that is never closed doesn't gather the rest of a file.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(paths if isinstance(paths, str) else list(paths))
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
    )
    split = ["file_path", "split"]
    states = lines.withColumns({"_out": F.col("value").rlike(_OPENS).cast("int"), "_in": F.col("value").rlike(_STAYS_OPEN).cast("int")})
    states = states.filter("file_path IS NOT NULL AND split IS NOT NULL").repartition(*split)
    upto = Window.partitionBy(*split).orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stated = _composed(states, "after", "_out", "_in", "line", upto)
    stated = stated.withColumn("upto", F.sum(F.length("value") + 1).over(upto))
    entries = _split_entries(stated)
    rows = stated.join(entries, split).withColumn(
        "ends", (_then(F.col("entry"), F.col("after_out"), F.col("after_in")) == OUTSIDE).cast("int")
    )
    rows = rows.withColumn("record_no", F.col("first_no") + F.sum("ends").over(upto) - F.col("ends"))
    begun = F.min(F.col("upto") - F.length("value") - 1).over(Window.partitionBy(*split, "record_no"))
    carried = F.when(F.col("record_no") == F.col("first_no"), F.col("carried")).otherwise(0)
    place = F.col("upto") - F.length("value") - 1 - begun + carried
    kept = F.when(F.col("place") <= limit, F.struct("line", "value"))
    crosses = ((F.col("record_no") == F.col("first_no")) & (F.col("entry") == INSIDE)) | (F.col("ended") == 0)
    pieces = (
        rows.withColumn("place", place)
        .groupBy(*split, "record_no", "first_no", "entry")
        .agg(
            F.array_sort(F.collect_list(kept)).alias("parts"),
            F.max("ends").alias("ended"),
            F.max(F.col("place") + F.length("value")).alias("size"),
        )
        .select(*split, "record_no", F.array_join("parts.value", "\n").alias("text"), (F.size("parts") > 0).alias("kept"), "ended", "size", crosses.alias("crosses"))
    )
    whole = pieces.filter(~F.col("crosses")).select("file_path", "record_no", "text", "ended", "size")
    crossing = pieces.filter("crosses").groupBy("file_path", "record_no").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("kept"), F.struct("split", "text"))))["text"], "\n").alias("text"),
        F.max("ended").alias("ended"),
        F.max("size").alias("size"),
    )
    return whole.unionByName(crossing).select(
        "file_path",
        "record_no",
        F.regexp_replace("text", "\r$", "").alias("record"),
        (F.col("ended") == 0).alias("open"),
        (F.col("size") > limit).alias("too_long"),
    )


def _read_split(spark: SparkSession, paths, columns: Sequence[str], limit: int) -> DataFrame:
    if not isinstance(paths, str) and len(set(paths)) < len(paths):
        times = Counter(paths)
        rounds = [[path for path in times if times[path] > number] for number in range(max(times.values()))]
        return flatten(*[_read_split(spark, part, columns, limit) for part in rounds])
    schema = ", ".join(f"`{name}` string" for name in columns)
    records = split_records(spark, paths, limit)
    header = F.from_csv("record", schema, {"escape": '"'})
    same = F.coalesce(header == F.struct(*[F.lit(name).alias(name) for name in columns]), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("header of "), "file_path", F.lit(" differs"))).cast("boolean")
    keep = F.when(F.col("record_no") == 1, F.when(same, F.lit(False)).otherwise(wrong)).otherwise(F.trim("record") != "")
    rows = records.filter(keep)
    width = F.least(_width(F.col("record")), F.lit(len(columns) + 1))
    parsed = rows.withColumn("_fields", width).withColumn("_row", header)
    return _present(
        parsed.select(
            "file_path",
            F.when((F.col("_fields") != len(columns)) | F.col("open") | F.col("too_long"), F.col("record")).alias("record"),
            "_fields",
            "_row.*",
            "open",
            "too_long",
        ),
        columns,
    )


def _read_naive(spark: SparkSession, paths, columns: Sequence[str]) -> DataFrame:
    header = ",".join(columns)
    lines = read_lines(spark, paths).filter(F.col("value") != header).withColumnRenamed("value", "record")
    kept = F.rtrim("record", F.lit(","))
    parts = lines.withColumn("_parts", F.split(kept, ",")).withColumn(
        "_fields", F.when((kept == "") & (F.col("record") != ""), F.lit(0)).otherwise(F.size("_parts"))
    )
    return parts.select(
        "file_path",
        "record",
        "_fields",
        F.lit(False).alias("open"),
        F.lit(False).alias("too_long"),
        *[F.get(F.col("_parts"), position).alias(name) for position, name in enumerate(columns)],
    )


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    mode: str = QUOTED,
    newlines: str = SPLIT_FILES,
    fail_fast: bool = False,
    record_limit: int = RECORD_LIMIT,
) -> DataFrame:
    """Rows of files with the given header: file_path, tag, reason, record and the string columns.

    ``record`` is the raw text of rows whose width is not the header's (of every row in naive mode).
    A path listed twice is read twice. A file with another header fails the query
    in the quoting modes; use ``read_csv_json`` for files with differing headers.
    """
    if mode == NAIVE:
        rows = _read_naive(spark, paths, columns)
    elif mode not in (QUOTED, STRICT):
        raise ValueError(f"unknown mode {mode}")
    elif newlines == SPLIT_FILES:
        rows = _read_split(spark, paths, columns, record_limit)
    else:
        rows = _read_quoted(spark, paths, columns, newlines == WHOLE_FILES)
    problem = F.when(F.col("open"), F.raise_error("unterminated quote") if fail_fast else F.lit("unterminated quote"))
    problem = problem.when(F.col("too_long"), F.raise_error("record too long") if fail_fast else F.lit("record too long"))
    if mode != QUOTED:
        width = F.col("_fields")
        short = F.concat(F.lit("short row: "), width.cast("string"), F.lit(f" of {len(columns)} fields"))
        problem = problem.when(width < len(columns), F.raise_error(short) if fail_fast else short)
    return route(rows, problem).select(*_OUTPUT, *columns)


def read_notified(
    spark: SparkSession,
    pattern: str,
    notified: DataFrame,
    files: DataFrame,
    columns: Sequence[str],
    mode: str = STRICT,
    newlines: str = NO_NEWLINES,
) -> DataFrame:
    """Rows of the files of ``pattern`` that ``notified`` (with ``path``, ``tag`` and ``reason``) names, as often as it does.

    There is one scan, and paths meet in joins: rows with their file's notifications, and notifications with the ``files``
    there are. A path without a file is an error row, as is a notification that has none.
    """
    paths = notified.select(_plain_path(F.col("path")).alias("file_path"), "tag", "reason")
    times = paths.filter(F.col("tag") == MAIN).groupBy("file_path").agg(F.count(F.lit(1)).cast("int").alias("_times"))
    there = files.select(_plain_path(F.col("path")).alias("file_path")).distinct()
    missing = paths.join(there, "file_path", "left_anti").select(
        "file_path", F.lit(ERROR).alias("tag"), F.coalesce("reason", F.lit("no such file")).alias("reason")
    )
    rows = read_csv(spark, pattern, columns, mode, newlines).withColumn("file_path", _plain_path(F.col("file_path")))
    repeated = rows.join(times, "file_path").withColumn("_times", F.explode(F.array_repeat(F.lit(1), F.col("_times"))))
    return repeated.drop("_times").unionByName(missing, allowMissingColumns=True)


def to_json_rows(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Main rows as JSON text in ``row``: every present column, in header order."""
    text = F.when(F.col("tag") == MAIN, row_json(list(columns), keep_nulls=False))
    return rows.select(*_OUTPUT, text.alias("row"))


def read_csv_json(
    spark: SparkSession, paths: Sequence[str], mode: str = QUOTED, newlines: str = SPLIT_FILES
) -> DataFrame:
    """Files with any headers, as JSON rows: file_path, tag, reason, record, row.

    The headers are read first (one row per file); files with the same header then share one scan.
    """
    times = Counter(paths)
    by_header: dict[str, list[str]] = defaultdict(list)
    for row in file_headers(spark, sorted(times)).toLocalIterator():
        by_header[row["header"]].append(row["file_path"])
    named = {_plain(path): count for path, count in times.items()}
    frames = []
    for header, files in sorted(by_header.items()):
        columns = header_names(header)
        wanted = [path for path in files for _ in range(named[_plain(path)])]
        frames.append(to_json_rows(read_csv(spark, wanted, columns, mode, newlines), columns))
    if not frames:
        return spark.createDataFrame([], "file_path string, tag string, reason string, record string, row string")
    return flatten(*frames)


def header_names(header: str) -> list[str]:
    """The column names of a header line, read by the rules of its rows."""
    return next(csv.reader([header]))


def _plain(path: str) -> str:
    """A path without the scheme of a local file, as readers spell it in different ways."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith(("file:", "/")) else path


def keyed_lines(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Lines other than the header, keyed by file: file_path, row (JSON of header to value)."""
    rows = read_csv(spark, paths, columns, NAIVE)
    return rows.select("file_path", row_json(list(columns), keep_nulls=False).alias("row"))


def file_trace(rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Two trace rows per file, ``start`` and ``end``, the latter with its rows and errors.

    ``files`` (with ``path``) adds those that gave no row at all.
    """
    counts = [F.count_if(F.col("tag") == tag).alias(name) for tag, name in ((MAIN, "rows"), (ERROR, "errors"))]
    if files is not None:
        nothing = F.lit(None).cast("string").alias("tag")
        rows = rows.select("file_path", "tag").unionByName(files.select(_plain_path(F.col("path")).alias("file_path"), nothing))
    counted = rows.groupBy(_plain_path(F.col("file_path")).alias("file_path")).agg(*counts)
    ended = F.concat_ws(" ", F.lit("read"), F.col("rows").cast("string"), F.lit("rows with"), F.col("errors").cast("string"), F.lit("errors"))
    return counted.select(
        "file_path",
        F.inline(F.array(
            F.struct(F.lit("start").alias("step"), F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("errors"), F.lit("opened").alias("message")),
            F.struct(F.lit("end").alias("step"), F.col("rows"), F.col("errors"), ended.alias("message")),
        )),
    )


def _plain_path(path: Column) -> Column:
    """``_plain`` as a column."""
    return F.when(path.rlike("^(file:|/)"), F.regexp_replace(path, "^(file:)?/*", "/")).otherwise(path)


def write_quoted(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """CSV that ``quoted`` mode reads back unchanged, in files of limited size."""
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def write_lines(
    df: DataFrame,
    line: Column,
    header: str,
    path: str,
    rows_per_file: int = 10_000_000,
    partition_by: Sequence[str] = (),
) -> None:
    """Ready-made lines below one header line per file, written verbatim."""
    (
        df.select(line.alias(header), *partition_by)
        .write.option("header", True)
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*partition_by)
        .csv(path)
    )
