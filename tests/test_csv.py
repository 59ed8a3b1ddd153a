import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import routing
from tidemark.sources import csv_files
from tidemark.sources.messages import notification_paths

EDGE = (
    "id,name,v\n"
    "1,x,2\n"
    "2,y,\n"
    "3,,4\n"
    "\n"
    '4,"q,c",5\n'
    "5,short\n"
    "6,p,7,extra\n"
    '7,"line1\nline2 ""z""",8\n'
    ",,\n"
    '"",b,"c,"\n'
)
COLUMNS = ["id", "name", "v"]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    (folder / "edge.csv").write_text(EDGE)
    (folder / "other.csv").write_text("v,id,name\n10,11,n\n")
    return folder


def rows_of(frame):
    return {tuple(row[name] for name in COLUMNS) for row in frame.collect()}


FULL = {
    ("1", "x", "2"), ("2", "y", ""), ("3", "", "4"), ("4", "q,c", "5"), ("6", "p", "7"),
    ("7", 'line1\nline2 "z"', "8"), ("", "", ""), ("", "b", "c,"),
}


@pytest.fixture(params=[csv_files.WHOLE_FILES, csv_files.SPLIT_FILES, "tiny splits"])
def newlines(request, spark):
    """The ways to read embedded newlines, the last with splits of a few bytes."""
    if request.param != "tiny splits":
        yield request.param
        return
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    for name, value in zip(names, ("9", "1", "1")):
        spark.conf.set(name, value)
    yield csv_files.SPLIT_FILES
    for name in names:
        spark.conf.unset(name)


def test_quoted(spark, files, newlines):
    rows = csv_files.read_csv(spark, str(files / "edge.csv"), COLUMNS, newlines=newlines)
    assert rows_of(rows) == FULL | {("5", "short", None)}
    assert {row["tag"] for row in rows.collect()} == {"main"}


def test_strict(spark, files, newlines):
    rows = csv_files.read_csv(spark, str(files / "edge.csv"), COLUMNS, csv_files.STRICT, newlines)
    assert rows_of(routing.output(rows, routing.MAIN)) == FULL
    error = routing.output(rows, routing.ERROR).collect()
    assert [(r["record"], r["reason"]) for r in error] == [("5,short", "short row: 2 of 3 fields")]
    assert error[0]["file_path"].endswith("edge.csv")
    assert rows.groupBy("tag").count().count() == 2


def test_naive(spark, files):
    rows = csv_files.read_csv(spark, str(files / "edge.csv"), COLUMNS, csv_files.NAIVE)
    main = rows_of(routing.output(rows, routing.MAIN))
    assert main == {("1", "x", "2"), ("3", "", "4"), ("4", '"q', 'c"'), ("6", "p", "7"), ('""', "b", '"c')}
    short = {row["record"] for row in routing.output(rows, routing.ERROR).collect()}
    assert short == {"2,y,", "", "5,short", '7,"line1', 'line2 ""z""",8', ",,"}
    with pytest.raises(Exception, match="short row"):
        csv_files.read_csv(spark, str(files / "edge.csv"), COLUMNS, csv_files.NAIVE, fail_fast=True).collect()


def test_repeated_path_is_read_twice(spark, files, newlines):
    path = str(files / "edge.csv")
    assert csv_files.read_csv(spark, [path, path], COLUMNS, newlines=newlines).count() == 18


def test_wrong_header_fails(spark, files, newlines):
    with pytest.raises(Exception, match="(?i)header"):
        csv_files.read_csv(spark, str(files / "other.csv"), COLUMNS, newlines=newlines).collect()


def test_split_records_keep_line_ends(spark, tmp_path):
    (tmp_path / "crlf.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n2,z\r\n')
    rows = csv_files.split_records(spark, str(tmp_path / "crlf.csv")).orderBy("record_no").collect()
    assert [(r["record_no"], r["record"]) for r in rows] == [(1, "a,b"), (2, '1,"x\r\ny"'), (3, "2,z")]


def test_files_with_different_headers(spark, files):
    listed = csv_files.match_files(spark, str(files / "*.csv"))
    edge, other = (f"file:{files}/{name}" for name in ("edge.csv", "other.csv"))
    notified = spark.createDataFrame([(edge,), (other,), (other,), (f"file:{files}/gone.csv",)], "path string")
    paths, missing = csv_files.matched_paths(notified, listed)
    assert sorted(paths) == sorted([edge, other, other])
    assert [(r["tag"], r["reason"]) for r in missing.collect()] == [("error", "no such file")]
    rows = csv_files.read_csv_json(spark, paths).collect()
    parsed = [json.loads(row["row"]) for row in rows]
    assert parsed.count({"v": "10", "id": "11", "name": "n"}) == 2
    assert {"id": "5", "name": "short"} in parsed and len(parsed) == 11


def test_notifications(spark):
    attributes = [{"bucketId": "b", "objectId": "o/x.csv", "eventType": "X"}, {"bucketId": "b"}, {"objectId": "o"}]
    rows = notification_paths(spark.createDataFrame([(a,) for a in attributes], "attributes map<string,string>"))
    assert [tuple(r) for r in rows.select("path", "tag", "reason").collect()] == [
        ("gs://b/o/x.csv", "main", None), (None, "error", "no objectId"), (None, "error", "no bucketId"),
    ]


def test_traces_of_files_with_and_without_rows(spark, files):
    rows = csv_files.read_csv(spark, str(files / "edge.csv"), COLUMNS, csv_files.STRICT)
    seen = spark.createDataFrame([(f"file:///{files}/edge.csv",), (f"file:{files}/empty.csv",)], "path string")
    traced = {(r["file_path"].rsplit("/", 1)[-1], r["step"]): (r["rows"], r["errors"], r["message"]) for r in csv_files.file_trace(rows, seen).collect()}
    assert traced == {
        ("edge.csv", "start"): (0, 0, "opened"), ("edge.csv", "end"): (8, 1, "read 8 rows with 1 errors"),
        ("empty.csv", "start"): (0, 0, "opened"), ("empty.csv", "end"): (0, 0, "read 0 rows with 0 errors"),
    }


STRAY = 'id,name,v\n1,a"b,2\n3,c,4\n5,"d ""e"",\n\n,f",6\n7,g"",8\n"9",h\n10,,"x\n11,i,12\n'


def test_stray_and_open_quotes_lose_no_row(spark, tmp_path, newlines):
    if newlines == csv_files.WHOLE_FILES:
        pytest.skip("for well formed files")
    (tmp_path / "stray.csv").write_text(STRAY)
    rows = csv_files.read_csv(spark, str(tmp_path / "stray.csv"), COLUMNS, csv_files.STRICT, newlines).collect()
    main = {tuple(r[n] for n in COLUMNS) for r in rows if r["tag"] == "main"}
    assert main == {("1", 'a"b', "2"), ("3", "c", "4"), ("5", 'd "e",\n\n,f', "6"), ("7", 'g""', "8")}
    errors = {(r["record"], r["reason"]) for r in rows if r["tag"] == "error"}
    assert errors == {('"9",h', "short row: 2 of 3 fields"), ('10,,"x\n11,i,12', "unterminated quote")}


def test_random_files_split_anywhere(spark, tmp_path):
    """Splits of a few bytes against Python's reading of the same text, character by character."""
    random.seed(4)
    pieces = ["a", ",", "\n", '"', '""', ',"', '",', "\n", "bc", '\n"']
    for number in range(30):
        (tmp_path / f"{number}.csv").write_text("".join(random.choices(pieces, k=random.randint(1, 60))))
    expected = {}
    for number in range(30):
        state, records, text = "start", [[]], (tmp_path / f"{number}.csv").read_text().removesuffix("\n")
        for at, sign in enumerate(text):
            if state == "quoted" and sign == '"':
                state = "closing"
            elif state == "closing" and sign == '"':
                state = "quoted"
            elif state != "quoted" and sign in ",\n":
                state = "start"
            elif state == "start" and sign == '"':
                state = "quoted"
            elif state != "quoted":
                state = "field"
            if sign == "\n" and state != "quoted":
                records.append([])
            else:
                records[-1].append(sign)
        for place, record in enumerate(records):
            last = place == len(records) - 1
            expected[number, place + 1] = ("".join(record), last and state == "quoted")
    for name, value in (("spark.sql.files.maxPartitionBytes", "9"), ("spark.sql.files.openCostInBytes", "1"), ("spark.sql.files.minPartitionNum", "1")):
        spark.conf.set(name, value)
    try:
        rows = csv_files.split_records(spark, str(tmp_path)).collect()
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{name}")
    found = {(int(r["file_path"].rsplit("/", 1)[-1][:-4]), r["record_no"]): (r["record"], r["open"]) for r in rows}
    assert len(found) == len(rows)
    empty = {key for key in expected if key not in found}
    assert all(expected.pop(key) == ("", False) for key in empty)  # an empty last line is no record
    assert found == expected


def test_an_unclosed_record_is_bounded(spark, tmp_path, newlines):
    """An error row has no more than the limit and its last line, whether the quote is closed in the end or never; later rows are read."""
    if newlines == csv_files.WHOLE_FILES:
        pytest.skip("whole files have no limit")
    body = "\n".join(f"line {n}" for n in range(400))
    (tmp_path / "long.csv").write_text(f'id,name,v\n1,a,b\n2,"{body}",c\n3,d,e\n4,"{body}\n')
    rows = csv_files.read_csv(spark, str(tmp_path / "long.csv"), COLUMNS, csv_files.STRICT, newlines, record_limit=100).collect()
    assert {tuple(r[n] for n in COLUMNS) for r in rows if r["tag"] == "main"} == {("1", "a", "b"), ("3", "d", "e")}
    errors = {r["reason"]: r["record"] for r in rows if r["tag"] == "error"}
    assert errors.keys() == {"record too long", "unterminated quote"}
    assert all(100 <= len(record) < 120 and f'"{body}'.startswith(record[2:]) for record in errors.values())


def test_header_names_and_no_files(spark, tmp_path):
    assert csv_files.header_names('"id","na,me",v') == ["id", "na,me", "v"]
    (tmp_path / "empty.csv").write_text("")
    rows = csv_files.read_csv_json(spark, [str(tmp_path / "empty.csv")])
    assert rows.collect() == [] and rows.columns == ["file_path", "tag", "reason", "record", "row"]


def test_keyed_lines(spark, files):
    rows = csv_files.keyed_lines(spark, str(files / "other.csv"), ["v", "id", "name"]).collect()
    assert [json.loads(r["row"]) for r in rows] == [{"v": "10", "id": "11", "name": "n"}]


def test_lines_round_trip(spark, tmp_path):
    lines = ['"a",b', "  lead", "trail  ", "x\\y", "'"]
    path = str(tmp_path / "out")
    csv_files.write_lines(spark.createDataFrame([(x,) for x in lines], "l string"), F.col("l"), "a,b", path)
    read = [r["value"] for r in csv_files.read_lines(spark, path).collect()]
    assert sorted(set(read) - {"a,b"}) == sorted(lines)


def test_format_errors(spark):
    rows = spark.createDataFrame([("main", None, "1"), ("main", None, "x"), ("error", "bad", "y")], "tag string, reason string, t string")
    done = routing.format_with_capture(rows, lambda c: c.try_cast("int"), "t", "n", "not a number")
    assert [tuple(r) for r in done.select("tag", "reason", "n").collect()] == [
        ("main", None, 1), ("error", "not a number", None), ("error", "bad", None),
    ]
