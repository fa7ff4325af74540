"""WARC records of web pages in seekable Zstandard bundles.

Records are grouped into independent frames; a bundle ends with a seek table (the public
seekable format: a skippable frame with the sizes of all frames), and an index maps each page
to bundle, frame, and the record's place inside the frame's text. So a record is read by
decompressing one frame.

Of pages with equal payloads of at least ``min_bytes`` the one with the smallest page_id is
written in full (``response``); the others become ``revisit`` records with headers alone.
Rows that repeat that smallest id are all written in full; a row without an id revisits it.
Payloads that only rows without ids have are written in full. A null html is an empty payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import partial
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.llm import blobs
from logledger.llm.staging import stored, text_batches
from logledger.sources.files import shared_folder

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 1 << 30
MIN_REVISIT_BYTES = 0
#: Tables of up to this many rows (checked by a count) are broadcast.
BROADCAST_ROWS = 200_000
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the seekable format and of WARC.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NONE = "none"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; with ``refers_to`` a revisit, whose block is the HTTP header alone."""
    name = lambda i: f"<urn:page:{_NONE if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        safe = "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (names in lower case) and what follows them."""

    def headers(text: bytes) -> dict[str, str]:
        lines = text.decode().split("\r\n")[1:]
        return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}

    head, _, rest = data.partition(b"\r\n\r\n")
    warc = headers(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, headers(http), payload


class Bundle:
    """Writes records in frames and the seek table at the end."""

    def __init__(self, out: BinaryIO):
        self.out = out
        self.pending: list[bytes] = []
        self.held = 0
        self.frames: list[tuple[int, int]] = []
        self.written = 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """(frame, offset in the frame's text, length)."""
        place = (len(self.frames), self.held, len(data))
        self.pending.append(data)
        self.held += len(data)
        if self.held >= FRAME_BYTES:
            self.flush()
        return place

    def flush(self) -> None:
        if self.pending:
            packed = zstandard.ZstdCompressor(level=3).compress(b"".join(self.pending))
            self.out.write(packed)
            self.frames.append((len(packed), self.held))
            self.written += len(packed)
            self.pending, self.held = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Finds frames by the seek table in the footer."""

    def __init__(self, source: BinaryIO):
        self.source = source
        source.seek(0, 2)
        end = source.tell()
        source.seek(end - 9)
        count, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        source.seek(end - 9 - 8 * count)
        table = source.read(8 * count)
        self.places, at = [], 0
        for packed, size in struct.iter_unpack("<II", table):
            self.places.append((at, packed, size))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, size = self.places[number]
        self.source.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=size)


_INDEX = "page_id bigint, path string, frame int, frame_offset bigint, length bigint"


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
        [n for n, _ in fields],
    )


def _write_task(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bundle, path = None, ""
    for batch in batches:
        rows = []
        columns = (batch[c].to_pylist() for c in ("page_id", "url", "html", "refers_to"))
        for page_id, url, html, refers_to in zip(*columns, strict=True):
            if bundle is None:
                path = blobs.new_name(folder, "warc.zst")
                bundle = Bundle(blobs.create(path))
            place = bundle.add(record(page_id, url, (html or "").encode(), refers_to))
            rows.append((page_id, path, *place))
            if bundle.written > BUNDLE_BYTES:
                bundle.close()
                bundle = None
        yield _arrow(rows, _INDEX)
    if bundle is not None:
        bundle.close()


def write_bundles(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes all pages; returns the index (page_id, path, frame, frame_offset, length)."""
    spark = pages.sparkSession
    text_batches(spark)
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint"), "url", html.alias("html"), F.sha1(html).alias("sha")
    )
    groups = rows.filter(F.octet_length("html") >= min_bytes).groupBy("sha")
    repeated = groups.agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = stored(repeated.filter("n > 1 AND first IS NOT NULL").select("sha", "first"), "repeated")
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    # The digest is unique on the right: a payload that very many pages share is split freely.
    marked = rows.join(repeated, "sha", "left").select(
        "page_id", "url", "html",
        F.when(F.col("first").eqNullSafe(F.col("page_id")), None).otherwise(F.col("first")).alias("refers_to"),
    )
    folder = shared_folder(spark, "warc")
    return stored(marked.mapInArrow(partial(_write_task, folder), _INDEX), "warc-index")


_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _number(name: str | None) -> int | None:
    text = name[len("<urn:page:") : -1] if name else _NONE
    return None if text == _NONE else int(text)


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened: tuple[str, BundleReader] | None = None
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("path", "frame", "places"))
        for path, frame, places in zip(*columns, strict=True):
            if opened is None or opened[0] != path:
                if opened:
                    opened[1].source.close()
                opened = (path, BundleReader(blobs.read(path)))
            text, rows = opened[1].frame(frame), []
            for place in places:
                start = place["frame_offset"]
                warc, http, payload = parse(text[start : start + place["length"]])
                kind = warc["warc-type"]
                own = kind == "response"
                rows.append(
                    (
                        _number(warc["warc-record-id"]),
                        len(payload) if own else int(http["content-length"]),
                        digest(payload) if own else warc["warc-payload-digest"].removeprefix("sha1:"),
                        kind,
                        _number(warc.get("warc-refers-to")),
                    )
                )
            yield _arrow(rows, _READ)
    if opened:
        opened[1].source.close()


def read_bundles(index: DataFrame) -> DataFrame:
    """The records an index names, whole or a selection of it, each frame decompressed once."""
    # A frame is of bounded size, and so is its list of records.
    frames = index.groupBy("path", "frame").agg(
        F.sort_array(F.collect_list(F.struct("frame_offset", "length"))).alias("places")
    )
    tasks = min(max(1, frames.count() // 16), 10_000)
    spread = frames.repartition(tasks, "path", (F.col("frame") / 16).cast("int"))
    return spread.sortWithinPartitions("path", "frame").mapInArrow(_read_task, _READ)


def warc_digest(pages: DataFrame) -> DataFrame:
    return read_bundles(write_bundles(pages))


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(sha, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31
      AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (html)
"""
