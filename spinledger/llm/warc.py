"""Web archives: records written and read back, and their captures in global order."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from itertools import groupby
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .loser_tree import merge_runs
from .tables import prepare, table

# The record format, and the contract's smallest payload that is deduplicated.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_BYTES = 0
# Records of a file: reading takes a file as a whole, so files stay small.
FILE_RECORDS = 500
# Pages carry no time of capture; they get one second each, by page_id, from here on.
FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=timezone.utc)

_RECORDS = (
    "page_id bigint, url string, url_key string, captured string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, file string, position bigint"
)
_NAMES = [part.split()[0] for part in _RECORDS.split(", ")]


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """The host reversed, then path and query: captures of a page sort side by side."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return (url or "").strip().lower()
    host = host.removeprefix("www.")
    named = ",".join(reversed(host.split(".")))
    if port and port not in (80, 443):
        named += f":{port}"
    query = "?" + "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{named}){parts.path or '/'}{query}"


def capture_time(page_id: int | None) -> str:
    seconds = (page_id or 0) % (1 << 32)
    return (FIRST_CAPTURE + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record_text(page_id: int | None, url: str | None, html: str, digest: str, size: int, refers_to: int | None, revisit: bool) -> str:
    """One record without its very last line feed, which the line writer adds."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    length = len(http) + (0 if revisit else size)
    safe_url = "".join(char if char > " " else f"%{ord(char):02X}" for char in url) if url is not None else None
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        *([f"WARC-Target-URI: {safe_url}"] if safe_url is not None else []),
        f"WARC-Date: {capture_time(page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {length}",
    ]
    return "\r\n".join(head) + "\r\n\r\n" + http + ("" if revisit else html) + "\r\n\r"


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """A record per row of ``pages`` (page_id, url, html) in gzip files below ``path``.

    Of rows with equal payloads of at least ``min_bytes`` the one with the largest page_id
    is a response, the others are revisits that refer to it. A null html is an empty
    payload. Rows that repeat the largest page_id with the same payload are responses too;
    rows without page_id are revisits unless no row of the payload has one. A null url gives
    a record without target. Other columns are ignored; an empty table gives no record.

    Spark's text writer stores the files, so any file system it knows will do.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    keyed = rows.withColumn("hash", F.sha1("html")).withColumn("size", F.octet_length("html"))
    # Small rows only: which page is the response of each payload, reduced before the shuffle.
    first = keyed.groupBy("hash", "size").agg(F.max("page_id").alias("original"))
    joined = keyed.join(first, ["hash", "size"])
    revisit = (F.col("size") >= min_bytes) & F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    marked = joined.select("page_id", "url", "html", "hash", F.col("size").cast("bigint").alias("size"), "original", revisit.alias("revisit"))
    marked.mapInArrow(_record_rows, "value string").write.options(
        lineSep="\n", compression="gzip", maxRecordsPerFile=str(FILE_RECORDS)
    ).text(path)


def _record_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = []
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            page_id, url, html, digest, size, original, revisit = row
            base32 = base64.b32encode(bytes.fromhex(digest)).decode()
            values.append(record_text(page_id, url, html, base32, size, original if revisit else None, revisit))
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, header, block) of every record in uncompressed archive bytes."""
    stream = io.BytesIO(data)
    while True:
        position = stream.tell()
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at {position}")
        header: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            header[name.strip().lower()] = value.strip()
        size = int(header["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record at {position} is cut off")
        yield position, header, block


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Captures of the archives below ``path``, checked against their digests.

    The payload of a revisit is that of the record it refers to: its size and digest are
    those that the revisit's own header states.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(_capture_rows, _RECORDS)


def _capture_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            rows = []
            for position, header, block in parse_records(gzip.decompress(content.as_buffer())):
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.decode().lower().partition("content-length:")[2].split("\r\n")[0])
                digest = header["warc-payload-digest"].removeprefix("sha1:")
                kind = header["warc-type"]
                if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
                    raise ValueError(f"damaged payload at {position} of {path}")
                url = header.get("warc-target-uri")
                rows.append(
                    (_page(header["warc-record-id"]), url, url_key(url), header["warc-date"], size, digest, kind, _page(header.get("warc-refers-to")), path.as_py(), position)
                )
            # The run of this file, sorted where it was read.
            rows.sort(key=_order)
            yield _batch(rows)


def _order(row: tuple) -> tuple:
    return row[2], row[3], row[0] is not None, row[0] or 0, row[8], row[9]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    types = [kinds[part.split()[1]] for part in _RECORDS.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], _NAMES)


def capture_histories(captures: DataFrame) -> DataFrame:
    """Captures in the global order of URL key and time, with their place in the history.

    Range partitions by key, time and page cut the sorted runs of all files; a page that
    was captured very often spreads over several. Each task merges the pieces of its runs
    with a loser tree. Partitions follow each other in order.
    """
    ranges = captures.repartitionByRange("url_key", "captured", "page_id")
    return ranges.sortWithinPartitions("file", "url_key", "captured", "page_id", "position").mapInArrow(_merged_rows, _RECORDS)


def _merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True)]
    runs = [iter([(_order(row), row) for row in run]) for _, run in groupby(rows, key=lambda row: row[8])]
    merged: list[tuple] = []
    for _, row in merge_runs(runs):
        merged.append(row)
        if len(merged) == 10_000:
            yield _batch(merged)
            merged = []
    if merged:
        yield _batch(merged)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return capture_histories(read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = """
with pages_ as (
  select page_id, url, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), bits as (
  select *, array_to_string(list_transform(string_split(h, ''), lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', strpos('0123456789abcdef', c) * 4 - 3, 4)), '') as b,
         max(page_id) over (partition by h) as original
  from pages_
)
select page_id, strlen(html) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * cast(substr(b, 5 * i + 1, 1) as int) + 8 * cast(substr(b, 5 * i + 2, 1) as int) + 4 * cast(substr(b, 5 * i + 3, 1) as int)
      + 2 * cast(substr(b, 5 * i + 4, 1) as int) + cast(substr(b, 5 * i + 5, 1) as int), 1)), '') as payload_digest,
  case when page_id = original then 'response' else 'revisit' end as record_type,
  case when page_id = original then null else original end as refers_to
from bits
"""
