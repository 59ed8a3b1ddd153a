"""WARC archives of web captures, read back and merged into one ordered index of capture histories.

Writing: every capture becomes a record. Of captures with equal payloads the one with the smallest id is a ``response`` with
the payload; the others are ``revisit`` records that refer to it and keep its digest and length. Spark's text writer puts the records, parted
as the format asks, into gzipped archives in the shared folder.

Reading: every archive is read as one stream of records by their stated lengths. Its captures, sorted by URL key and
time, are one run. The runs are dealt out by ranges of (URL key, time, id), which keeps each run's order, and
in every range a loser tree merges them: with k runs a capture costs log k comparisons. Ranges end between
captures, so a URL with very many captures takes several. The result is in global order by ``range`` and ``place``.

Defined cases: a null payload is empty; a null id is written as such, is never the smallest unless all are null, and comes last among
captures of one URL and time; rows with the smallest id of their payload are all responses; a null URL has the key ``""``; line breaks in a URL are
percent-encoded; a null time is the epoch; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import written
from tidemark.session import scratch_path

PARTING = "\r\n\r\n"
RECORDS_PER_FILE = 20_000
CAPTURES_PER_RANGE = 50_000
CHUNK = 1 << 20
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
CAPTURE = "page_id long, url string, url_key string, captured_at string, record_type string, payload_bytes long, payload_digest string, refers_to long"
RUN = f"run string, number long, record_offset long, {CAPTURE}"


def base32_sha1(payload: Column) -> Column:
    """The digest in upper-case base32: twenty bits, five hex digits, are four letters."""
    digest = F.sha1(payload)
    fives = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*fives), BASE32_DIGITS, BASE32_LETTERS)


def _name(ident: Column) -> Column:
    return F.concat(F.lit("<urn:capture:"), F.coalesce(ident.cast("string"), F.lit("null")), F.lit(">"))


def write_archives(
    pages: DataFrame, captured_at: Column, ident: str = "page_id", url: str = "url", payload: str = "html"
) -> str:
    """Write all rows as records and return the archives' folder.

    The payloads that occur more than once are written as a table of digests first: small, it goes to all executors and the payloads
    stay where they are; else the join is shuffled and a hot digest is split.
    """
    body = F.coalesce(pages[payload].cast("string"), F.lit(""))
    rows = pages.select(
        pages[ident].cast("bigint").alias("id"), pages[url].cast("string").alias("url"), captured_at.alias("at"),
        body.alias("body"), F.sha2(body, 256).alias("digest"),
    )
    repeated = (
        rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    )
    known = written(repeated.select("digest", "first"), "repeated-payloads")
    joined = rows.join(known, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("body").cast("string"), F.lit(PARTING),
    )
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("body")))
    zone_free = F.to_utc_timestamp(F.coalesce("at", F.timestamp_seconds(F.lit(0))), F.current_timezone())
    clean_url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), _name(F.col("id"))),
        F.concat(F.lit("WARC-Date: "), F.date_format(zone_free, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), clean_url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_sha1(F.col("body"))),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), _name(F.col("first")))),
        F.when(again, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(PARTING), block)
    path = scratch_path(pages.sparkSession, "warc")
    writer = joined.select(record.alias("value")).write.option("lineSep", PARTING).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    return path


class Inflated:
    """Reads a gzipped archive piece by piece."""

    def __init__(self, content: bytes):
        self.content, self.at, self.offset = memoryview(content), 0, 0
        self.inflater, self.ready = zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        if self.at >= len(self.content):
            return False
        given = self.content[self.at : self.at + CHUNK]
        piece = self.inflater.decompress(given)
        self.at += len(given)
        if self.inflater.eof and self.inflater.unused_data:
            self.at -= len(self.inflater.unused_data)
            self.inflater = zlib.decompressobj(31)
        self.ready += piece
        return True

    def take(self, count: int) -> bytes:
        while len(self.ready) < count:
            if not self._more():
                raise ValueError("the archive ends within a record")
        found = bytes(self.ready[:count])
        del self.ready[:count]
        self.offset += count
        return found

    def head(self) -> bytes | None:
        """The bytes up to the next empty line; None at the end."""
        seen = 0
        while (end := self.ready.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.ready)
            if not self._more():
                if self.ready.strip():
                    raise ValueError("the archive ends within a header")
                return None
        found = self.take(end + 4)
        return found[:-4]


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then the path and query: captures of one site are neighbours."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}


def _number(name: str) -> int | None:
    text = name.removeprefix("<urn:capture:").removesuffix(">")
    return None if text == "null" else int(text)


def captures(content: bytes) -> Iterator[dict]:
    """The captures of one archive in the order of their records; a payload that differs from its digest is an error."""
    stream = Inflated(content)
    while True:
        at = stream.offset
        head = stream.head()
        if head is None:
            return
        fields = _fields(head)
        block = stream.take(int(fields["content-length"]))
        stream.take(len(PARTING))
        http, _, payload = block.partition(PARTING.encode())
        size = int(_fields(http)["content-length"])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        kind = fields["warc-type"]
        if kind == "response":
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if len(payload) != size or found != digest:
                raise ValueError(f"record {fields['warc-record-id']} is damaged")
        yield {
            "record_offset": at, "page_id": _number(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
            "url_key": url_key(fields.get("warc-target-uri")), "captured_at": fields["warc-date"], "record_type": kind,
            "payload_bytes": size, "payload_digest": digest,
            "refers_to": _number(fields["warc-refers-to"]) if kind == "revisit" else None,
        }


def _order(capture: dict) -> tuple:
    page_id = capture["page_id"]
    return capture["url_key"], capture["captured_at"], page_id is None, page_id or 0


INTEGERS = ["number", "record_offset", "page_id", "payload_bytes", "refers_to"]


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    return frame.astype({name: "Int64" for name in columns if name in INTEGERS})


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One sorted run of captures per archive: ``run``, ``number`` in it, and the capture."""
    columns = [part.split()[0] for part in RUN.split(", ")]

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                run = sorted(captures(content), key=_order)
                for start in range(0, len(run), 10_000):
                    part = run[start : start + 10_000]
                    yield _frame([{"run": path, "number": start + i, **one} for i, one in enumerate(part)], columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")
    return files.mapInPandas(parse, RUN)


class LoserTree:
    """Merges sorted runs; every inner node keeps the run that lost there, so that a new head meets one rival per level."""

    def __init__(self, runs: list[list[dict]]):
        self.runs = runs
        self.heads = [0] * len(runs)
        self.losers = [-1] * max(1, len(runs))
        for run in range(len(runs)):
            self._replay(run)

    def _key(self, run: int) -> tuple:
        at = self.heads[run]
        return (0, _order(self.runs[run][at]), run) if at < len(self.runs[run]) else (1, (), run)

    def _replay(self, run: int) -> None:
        """Let the run's head climb; while the tree is being filled it stays at the first free node."""
        node = (run + len(self.runs)) // 2
        while node:
            rival = self.losers[node]
            if rival < 0:
                self.losers[node] = run
                return
            if self._key(rival) < self._key(run):
                self.losers[node], run = run, rival
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[dict]:
        while self.runs:
            run = self.losers[0]
            if self.heads[run] >= len(self.runs[run]):
                return
            yield self.runs[run][self.heads[run]]
            self.heads[run] += 1
            self._replay(run)


def merge(runs: DataFrame) -> DataFrame:
    """All captures of the runs in global order of ``range`` and ``place``."""
    ranges = max(1, -(-runs.count() // CAPTURES_PER_RANGE))
    dealt = runs.repartitionByRange(ranges, "url_key", "captured_at", F.col("page_id").asc_nulls_last(), "run", "number")
    columns = ["range", "place", *[part.split()[0] for part in CAPTURE.split(", ")]]

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fragments: dict[str, list[dict]] = {}
        for frame in frames:
            frame = frame.astype({name: "Int64" for name in INTEGERS}).astype(object).where(lambda f: f.notna(), None)
            for row in frame.to_dict("records"):
                fragments.setdefault(row["run"], []).append(row)
        for fragment in fragments.values():
            # A run's captures arrive in its order, but for a map task that was run again in between.
            fragment.sort(key=lambda row: row["number"])
        number, rows = TaskContext.get().partitionId(), []
        for place, capture in enumerate(LoserTree(list(fragments.values()))):
            rows.append({**capture, "range": number, "place": place})
            if len(rows) == 10_000:
                yield _frame(rows, columns)
                rows = []
        if rows:
            yield _frame(rows, columns)

    return dealt.mapInPandas(merged, f"range int, place long, {CAPTURE}")


def histories(
    pages: DataFrame, captured_at: Column, ident: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """Write the archives, read them back, and merge their runs."""
    folder = write_archives(pages, captured_at, ident, url, payload)
    return merge(written(read_runs(pages.sparkSession, folder), "warc-runs"))
