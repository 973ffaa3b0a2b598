"""WARC archives as a chunked record table.

Writing: a payload is cut into segments of at most ``segment_bytes``; each is
a WARC record of its own (``response`` first, then ``continuation`` records,
as the standard's segmentation has it). Reading: archives are streamed line
by line; the table has a row per (record, chunk), each with the digest of the
payload so far, and no record is ever held whole. Files are written and read
by Spark (gzip, so one task streams one file), on any store it reaches.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm import common

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: fixed value of the standard: the profile of revisits by payload digest
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = pa.schema([
    ("record", pa.string()), ("chunk", pa.int64()), ("row_id", pa.int64()), ("record_type", pa.string()),
    ("target_uri", pa.string()), ("refers_to", pa.int64()), ("declared_digest", pa.string()),
    ("declared_bytes", pa.int64()), ("data", pa.binary()), ("bytes_so_far", pa.int64()),
    ("digest_so_far", pa.string()), ("last", pa.bool_()), ("cut", pa.bool_())])
CHUNKS_DDL = ("record string, chunk long, row_id long, record_type string, target_uri string, refers_to long, "
              "declared_digest string, declared_bytes long, data binary, bytes_so_far long, "
              "digest_so_far string, last boolean, cut boolean")


def base32_sha1(payload):
    """Upper-case base32 SHA-1 of a binary column: ten hex digits at a time
    are eight base-32 digits, renamed to the alphabet of RFC 4648."""
    hexed = F.sha1(payload)
    eight = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*eight), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def with_first_of_payload(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Adds ``refers_to``: for a payload of at least ``least_bytes`` that a
    row with a smaller id has too, the smallest such id, else null.

    Only (id, digest, length) rows meet by digest and length, pre-aggregated; payloads move
    once, by id, which spreads a hot payload over all tasks."""
    ids = pages.where(F.col("n_bytes") >= least_bytes).select("row_id", "digest", "n_bytes")
    firsts = (ids.groupBy("digest", "n_bytes").agg(F.min("row_id").alias("first"), F.max("row_id").alias("last_id"))
              .where("first < last_id").drop("last_id"))
    later = (ids.distinct().join(firsts, ["digest", "n_bytes"]).where("row_id > first")
             .select("row_id", "digest", "n_bytes", F.col("first").alias("refers_to")))
    return pages.join(later, ["row_id", "digest", "n_bytes"], "left")


def write(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html",
          uri_col: str = "url", least_bytes: int = 0, segment_bytes: int = 1 << 16, date: str | None = None) -> None:
    """Write a record per row; see ``read`` for what comes back.

    Of the rows with equal payloads (by SHA-1 and length) of at least
    ``least_bytes``, those with the smallest id become ``response`` records and
    the others ``revisit`` records without payload that name that id. Payload:
    the column as UTF-8 bytes, null as no bytes. A row with a null id is a
    response. Repeated rows are written each, under one record id. ``date``: the ``WARC-Date`` of all records
    (``2025-01-31T12:00:00Z``), by default the time of the call. Null URIs have no target line;
    line breaks in a URI are percent-encoded. An empty table gives no records.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.encode(common.text_of(payload_col), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("row_id"), F.col(uri_col).cast("string").alias("uri"),
                        payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("n_bytes"),
                       base32_sha1(F.col("payload")).alias("digest"))
    rows = with_first_of_payload(rows, least_bytes)

    revisit = F.col("refers_to").isNotNull()
    name = F.concat(F.lit("<urn:row:"), F.coalesce(F.col("row_id").cast("string"), F.lit("null")), F.lit(">"))
    segments = F.when(revisit, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / segment_bytes))).cast("int")
    rows = rows.withColumn("segments", segments).withColumn(
        "segment", F.explode(F.sequence(F.lit(1), F.col("segments"))))
    part = F.when(revisit, F.lit(b"")).otherwise(
        F.substring(F.col("payload"), (F.col("segment") - 1) * segment_bytes + 1, F.lit(segment_bytes)))
    first, last, single = F.col("segment") == 1, F.col("segment") == F.col("segments"), F.col("segments") == 1

    def line(key, value, when=None):
        text = F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
        return F.coalesce(text if when is None else F.when(when, text), F.lit(""))

    uri = F.replace(F.replace(F.col("uri"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).when(first, F.lit("response"))
             .otherwise(F.lit("continuation"))),
        line("WARC-Record-ID", F.when(first, name).otherwise(F.concat(
            F.lit("<urn:row:"), F.coalesce(F.col("row_id").cast("string"), F.lit("null")),
            F.lit(":"), F.col("segment").cast("string"), F.lit(">")))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri),
        line("X-Row-ID", F.col("row_id").cast("string")),
        line("WARC-Refers-To", F.concat(F.lit("<urn:row:"), F.col("refers_to").cast("string"), F.lit(">"))),
        line("WARC-Profile", F.lit(SAME_PAYLOAD), revisit),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")), first),
        line("X-Payload-Length", F.col("n_bytes").cast("string"), first),
        line("WARC-Segment-Origin-ID", name, ~first),
        line("WARC-Segment-Number", F.col("segment").cast("string"), ~single),
        line("WARC-Segment-Total-Length", F.col("n_bytes").cast("string"), last & ~single),
        line("Content-Length", F.octet_length("part").cast("string")),
        F.lit("\r\n"))
    # the writer ends each row with the record's last line feed
    record = F.concat(F.encode(header, "UTF-8"), F.col("part"), F.lit(b"\r\n\r"))
    (rows.withColumn("part", part).select(record.cast("string").alias("value"))
     .write.option("lineSep", "\n").option("compression", "gzip").text(path))


def _number(text: str | None) -> int | None:
    """The integer that a header value is; None for other values."""
    return int(text) if text is not None and re.fullmatch(r"-?[0-9]{1,18}", text) else None


class _Stream:
    """Follows records through the lines of one archive."""

    def __init__(self, chunk_bytes: int):
        self.chunk_bytes = chunk_bytes
        self.left = -1  # payload bytes still to come; -1: in or before a header
        self.head: dict[str, str] = {}
        self.name, self.sha, self.total, self.chunk = None, hashlib.sha1(), 0, 0
        self.held = bytearray()
        self.first: dict[str, str] = {}
        self.waiting = False  # a record has begun whose last segment is not complete

    def line(self, text: bytes):
        """Rows that a line (without its line feed) completes."""
        if self.left >= 0:
            yield from self.payload(text + b"\n")
            return
        text = text.rstrip(b"\r")
        if text:
            key, colon, value = text.decode("utf-8", "replace").partition(":")
            if colon:
                self.head[key.strip().lower()] = value.strip()
            elif key.startswith("WARC/") and self.head:
                yield from self.finish()  # a record begins in the head of another
            return
        if not self.head:  # blank lines between records
            return
        if _number(self.head.get("content-length")) is None:
            yield from self.finish()
            return
        if self.head.get("warc-type") != "continuation":
            if self.waiting:
                head, self.head = self.head, {}
                yield from self.finish()
                self.head = head
            self.begin()
        self.left = _number(self.head["content-length"])
        if not self.left:
            yield from self.end()

    def begin(self) -> None:
        self.first = self.head
        self.name, self.sha, self.total, self.chunk = self.head.get("warc-record-id"), hashlib.sha1(), 0, 0
        self.waiting = True

    def finish(self):
        """The archive ends or goes on with another record: one that is not complete, in its head,
        its bytes or its segments, is closed as cut."""
        if self.waiting:
            yield self.row(bytes(self.held), True, True)
            self.held.clear()
        if self.left < 0 and self.head and self.head.get("warc-type") != "continuation":
            self.begin()
            yield self.row(b"", True, True)
        self.left, self.head, self.waiting = -1, {}, False

    def payload(self, data: bytes):
        take = data[:self.left]
        self.left -= len(take)
        self.held += take
        while len(self.held) > self.chunk_bytes:
            yield self.row(bytes(self.held[:self.chunk_bytes]), False)
            del self.held[:self.chunk_bytes]
        if not self.left:
            yield from self.end()

    def end(self):
        """A record's bytes are complete; its last segment completes it."""
        if "warc-segment-number" not in self.head or "warc-segment-total-length" in self.head:
            yield self.row(bytes(self.held), True)
            self.held.clear()
            self.waiting = False
        self.left, self.head = -1, {}

    def row(self, data: bytes, last: bool, cut: bool = False) -> tuple:
        self.sha.update(data)
        self.total += len(data)
        h, refers = self.first, self.first.get("warc-refers-to")
        row = (self.name, self.chunk, _number(h.get("x-row-id")), h.get("warc-type"), h.get("warc-target-uri"),
               _number(refers.removeprefix("<urn:row:").rstrip(">")) if refers else None,
               (h.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
               _number(h.get("x-payload-length")), data, self.total,
               base64.b32encode(self.sha.copy().digest()).decode(), last, cut)
        self.chunk += 1
        return row


def read(spark: SparkSession, path: str, chunk_bytes: int = 1 << 16) -> DataFrame:
    """The chunk table of the gzip archives below ``path``.

    A row per (record, chunk): record (its id), chunk (from 0), row_id,
    record_type, target_uri, refers_to, declared_digest and declared_bytes
    (from the header), data, bytes_so_far, digest_so_far (bare base32 SHA-1),
    last and cut. A record without payload has one empty chunk. A record that is not complete (its
    archive ends, or a header without a valid length) ends with a chunk that is
    ``last`` and ``cut``. Header values that should be numbers and are not are null. Memory per task:
    one line and one chunk."""

    def parse(batches_in):
        stream, at, rows, held = _Stream(chunk_bytes), None, [], 0
        for batch in batches_in:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist()):
                done = list(stream.finish()) if name != at else []
                if name != at:
                    stream, at = _Stream(chunk_bytes), name
                for row in itertools.chain(done, stream.line(text)):
                    rows.append(row)
                    held += len(row[8]) + 200
                    if held > 4 << 20:
                        yield common.batches(rows, CHUNKS)
                        rows, held = [], 0
        rows += stream.finish()
        if rows:
            yield common.batches(rows, CHUNKS)

    lines = (spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path)
             .select(F.col("_metadata.file_path").alias("name"), F.col("value").cast("binary").alias("value")))
    return common.map_arrow(lines, parse, CHUNKS_DDL)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record, from its last chunk: row_id, record_type,
    refers_to, target_uri, payload_bytes, payload_digest (both of the full
    payload; a revisit has them from its header) and intact (the computed
    digest and length are the declared ones; null for a revisit; false for a record
    that was cut)."""
    revisit = F.col("record_type") == "revisit"
    return chunks.where("last").select(
        "row_id", "record_type", "refers_to", "target_uri",
        F.when(revisit, F.col("declared_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        F.when(F.col("cut"), False).when(~revisit, (F.col("declared_digest") == F.col("digest_so_far"))
               & (F.col("declared_bytes") == F.col("bytes_so_far"))).alias("intact"))
