import base64
import gzip
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

ROWS = [
    (1, "http://a.b/x\r\nWARC/1.1", "p"), (2, None, None), (None, "http://a.b/x", "p"),
    (3, "http://[bad", "x\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n"), (4, "https://www.É.com?q#f", "é\x00ü"), (0, "", ""),
    (1, "http://a.b/x", "p"), (5, "u", "x\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n"), (6, "http://a.b/x", "long " * 300_000),
]
SCHEMA = "page_id long, url string, html string, range int, run string"


def histories(spark, rows):
    pages = spark.createDataFrame([(*r, 1, "r") for r in rows], SCHEMA)
    return warc.histories(pages, F.timestamp_seconds(5 * F.col("page_id")))


def expected(rows):
    first: dict = {}
    for id_, _, html in rows:
        known = first.get(html or "")
        first[html or ""] = id_ if known is None else known if id_ is None else min(known, id_)
    result = Counter()
    for id_, _, html in rows:
        data, least = (html or "").encode(), first[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        result[(id_, len(data), digest, *(("response", None) if id_ == least else ("revisit", least)))] += 1
    return result


@pytest.mark.parametrize("per_range", [3, 50_000])
def test_odd_rows_come_back_in_order(spark, monkeypatch, per_range):
    monkeypatch.setattr(warc, "CAPTURES_PER_RANGE", per_range)
    found = sorted(histories(spark, ROWS).collect(), key=lambda r: (r.range, r.place))
    shown = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found)
    assert shown == expected(ROWS)
    keys = [(r.url_key, r.captured_at, r.page_id is None, r.page_id or 0) for r in found]
    assert keys == sorted(keys)


def test_empty_table(spark):
    assert histories(spark, []).collect() == []


def test_one_hot_url_and_payload(spark, monkeypatch):
    monkeypatch.setattr(warc, "CAPTURES_PER_RANGE", 100)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 50)
    rows = [(i, "http://hot/" if i % 3 else f"http://h{i}/", "same" if i % 2 else f"<p>{i}") for i in range(900)]
    found = sorted(histories(spark, rows).collect(), key=lambda r: (r.range, r.place))
    shown = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found)
    assert shown == expected(rows)
    keys = [(r.url_key, r.captured_at, r.page_id) for r in found]
    assert keys == sorted(keys)


def test_damage_is_an_error():
    good = (
        "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:capture:1>\r\nWARC-Date: d\r\n"
        "WARC-Payload-Digest: sha1:{}\r\nContent-Length: 41\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\n{}\r\n\r\n"
    )
    digest = base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    record = good.format(digest, "abc").encode()
    assert [c["payload_bytes"] for c in warc.captures(gzip.compress(record) + gzip.compress(record))] == [3, 3]
    with pytest.raises(ValueError, match="damaged"):
        list(warc.captures(gzip.compress(record.replace(b"abc\r\n", b"abd\r\n"))))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.captures(gzip.compress(record[:-9])))


def test_loser_tree_merges_any_number_of_runs():
    random.seed(1)
    runs = [
        sorted(
            (dict(url_key=random.choice("abc"), captured_at=str(random.randint(0, 9)), page_id=random.choice([None, 1, 2])) for _ in range(random.randint(0, 9))),
            key=warc._order,
        )
        for _ in range(13)
    ]
    for k in range(14):
        merged = [warc._order(one) for one in warc.LoserTree(runs[:k])]
        assert merged == sorted(warc._order(one) for run in runs[:k] for one in run)


def test_url_keys():
    assert warc.url_key("HTTP://WWW.Example.com/A?b=1#c") == "com,example)/A?b=1"
    assert warc.url_key(None) == warc.url_key("") == ""
