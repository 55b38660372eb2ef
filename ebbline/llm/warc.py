"""Seekable Zstandard bundles of WARC/1.1 records.

Records are grouped into independent frames of about ``FRAME_BYTES``; a bundle of frames
ends with a seek table in a skippable frame, so that any Zstandard reader can read the
bundle whole and a seeking reader opens one frame.  Each record's identifier maps to
(frame, offset inside the decompressed frame, length).

A bundle is one row (bundle, data, records) of a table that Spark writes, so the store may
be any that Spark reaches, and a lost task is written again or not at all.
:func:`export` writes the bundles of such a table as objects of their own.

A response holds an HTTP head and the payload, a revisit the head only.  A record's
identifier is derived from page_id, URL and payload, so a revisit can name its response
wherever that is written; rows alike in all three are one record, written again.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import keep, small_batches

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
#: Payloads below this size are always written in full.
REVISIT_BYTES = 1000
#: WARC-Date of pages whose time isn't known.
DATE = "1970-01-01T00:00:00Z"
BUNDLES = "bundle string, data binary, records array<struct<page_id:bigint,frame:int,start:bigint,length:bigint>>"

# Fixed values of the seekable format.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def classify(pages: DataFrame) -> DataFrame:
    """Pages with payload, payload_bytes, payload_digest, record_type and refers_to.

    Of equal payloads of at least REVISIT_BYTES, that of the largest page_id is the
    response, refers_url its URL (the largest, if the page has several).  A null payload is empty.  A null page_id is never a response that others
    refer to, unless all are null.  Rows that repeat a response's page_id and payload are
    responses too.  Counting is by digest before the join, whose one-row side lets Spark
    split a digest that many pages share.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    )
    own = pages.select(payload.alias("payload"), "page_id", "url").where(F.octet_length("payload") >= REVISIT_BYTES)
    last = own.groupBy(F.sha1("payload").alias("payload_digest")).agg(F.max(F.struct("page_id", "url")).alias("last"))
    revisit = (F.col("payload_bytes") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("last.page_id"))
    return rows.join(last, "payload_digest", "left").select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("last.page_id")).alias("refers_to"),
        F.when(revisit, F.col("last.url")).alias("refers_url"),
    )


def _identifier(page: int | None, url: str | None, digest: str) -> str:
    name = json.dumps([page, url, digest]).encode()
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name).digest()[:16], version=5)}>"


def _uri(url: str | None) -> str:
    """The URL with white space, controls and what isn't ASCII percent-encoded, as a URI must be."""
    return quote(url, safe="%!#$&'()*+,/:;=?@[]~-._") if url else "about:blank"


def _record(page, url, payload, size, digest, kind, refers, refers_url, date) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_identifier(page, url, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"X-Page: {json.dumps([page, size, refers])}",
    ]
    if _uri(url) != url:  # what the page has instead
        lines.append(f"X-Target: {json.dumps(url)}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_identifier(refers, refers_url, digest)}"]
        lines += [f"WARC-Refers-To-Target-URI: {_uri(refers_url)}", f"WARC-Refers-To-Date: {date}", "WARC-Truncated: length"]
    body = head + (payload or b"")
    lines += [f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


class _Bundle:
    """Frames and seek table of one bundle that is being written."""

    def __init__(self):
        self.frames, self.sizes, self.records = [], [], []
        self.open, self.open_bytes, self.bytes = [], 0, 0
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, page: int | None, record: bytes) -> None:
        self.records.append({"page_id": page, "frame": len(self.frames), "start": self.open_bytes, "length": len(record)})
        self.open.append(record)
        self.open_bytes += len(record)
        if self.open_bytes >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if self.open:
            self.frames.append(self.compressor.compress(b"".join(self.open)))
            self.sizes.append((len(self.frames[-1]), self.open_bytes))
            self.bytes += len(self.frames[-1])
            self.open, self.open_bytes = [], 0

    def data(self) -> bytes:
        self.end_frame()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, _SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", _SKIPPABLE, len(table)) + table


def _bundles(date: str):
    def bundles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, n, bundle = TaskContext.get().partitionId(), 0, _Bundle()

        def row() -> pd.DataFrame:
            return pd.DataFrame({"bundle": [f"{task:06d}-{n:06d}.warc.zst"], "data": [bundle.data()], "records": [bundle.records]})

        for batch in batches:
            ids = (None if pd.isna(x) else int(x) for x in batch["page_id"].astype("Int64"))
            refers = (None if pd.isna(x) else int(x) for x in batch["refers_to"].astype("Int64"))
            urls, refers_urls = ((None if pd.isna(x) else x for x in batch[c]) for c in ("url", "refers_url"))
            for page, url, payload, size, digest, kind, to, to_url in zip(
                ids, urls, batch["payload"], batch["payload_bytes"], batch["payload_digest"], batch["record_type"], refers, refers_urls, strict=True
            ):
                bundle.add(page, _record(page, url, payload, size, digest, kind, to, to_url, date))
                if bundle.bytes >= BUNDLE_BYTES:
                    yield row()
                    n, bundle = n + 1, _Bundle()
        if bundle.records:
            yield row()

    return bundles


def write_archives(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write pages (page_id, url, html; other columns are left out) as bundles to a table.

    `date` is the WARC-Date of all records, as pages have none of their own.  An empty table
    gives an empty table of bundles.  A page longer than a frame or a bundle is one record
    in a frame and a bundle of its own size.
    """
    small_batches(pages.sparkSession)
    ids = pages.withColumn("page_id", F.col("page_id").cast("long"))
    classify(ids).mapInPandas(_bundles(date), BUNDLES).write.parquet(path)


def export(spark, path: str, folder: str) -> DataFrame:
    """Write each bundle of the table at `path` as an object <bundle> into `folder`; (object, bytes).

    `folder` is a path or URI that pyarrow's file systems reach from every executor.  An
    object's name is its bundle's, so a task that runs again writes the same objects.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for name, data in zip(batch["bundle"], batch["data"], strict=True):
                with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                    out.write(data)
            yield pd.DataFrame({"object": batch["bundle"], "bytes": batch["data"].map(len)})

    return keep(spark.read.schema(BUNDLES).parquet(path).select("bundle", "data").mapInPandas(write, "object string, bytes long"), "warc-objects")


def seek_table(data: bytes) -> list[tuple[int, int]]:
    """(start, compressed bytes) of each frame, read from the end of a bundle."""
    frames, _, magic = struct.unpack("<IBI", data[-9:])
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    start, table = 0, []
    for compressed, _ in struct.iter_unpack("<II", data[-9 - 8 * frames : -9]):
        table.append((start, compressed))
        start += compressed
    return table


def read_frame(data: bytes, table: list[tuple[int, int]], frame: int) -> bytes:
    start, size = table[frame]
    return zstandard.ZstdDecompressor().decompress(data[start : start + size])


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload, what follows the HTTP head, of one record."""
    head, _, body = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, body[: int(headers["Content-Length"])].partition(b"\r\n\r\n")[2]


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _read(payloads: bool):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, records in zip(batch["data"], batch["records"], strict=True):
                table, rows, at, frame = seek_table(data), [], -1, b""
                for r in records:
                    if r["frame"] != at:
                        at, frame = r["frame"], read_frame(data, table, r["frame"])
                    headers, payload = parse(frame[r["start"] : r["start"] + r["length"]])
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].partition(":")[2]
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} doesn't match its digest")
                    page, size, refers = json.loads(headers["X-Page"])
                    url = json.loads(headers["X-Target"]) if "X-Target" in headers else headers["WARC-Target-URI"]
                    rows.append((page, size, digest, kind, refers, url, payload if payloads else None))
                    if len(rows) >= (100 if payloads else 10_000):
                        yield _frame(rows)
                        rows = []
                if rows:
                    yield _frame(rows)

    return read


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")])
    return out.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})


def read_archives(spark, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the bundles at a path, found through seek table and record map.

    Payloads of responses are checked against their digests; a revisit's is empty.
    """
    bundles = spark.read.schema(BUNDLES).parquet(path)
    return bundles.select("data", "records").mapInPandas(_read(payloads), READ)


def read_page(spark, path: str, page_id: int) -> DataFrame:
    """The records of one page: only its bundles are opened, and in them only its frames."""
    bundles = spark.read.schema(BUNDLES).parquet(path)
    own = F.filter("records", lambda r: r["page_id"] == page_id)
    return bundles.select("data", own.alias("records")).where(F.size("records") > 0).mapInPandas(_read(True), READ)
