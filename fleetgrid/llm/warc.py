r"""WARC archives written from pages and read back.

**Writing.**  Every row becomes a WARC/1.1 record with an HTTP message in
chunked transfer coding; payloads longer than ``SEGMENT_BYTES`` are cut into
segments: the first record carries ``WARC-Segment-Number: 1``, the others are
``continuation`` records that name it in ``WARC-Segment-Origin-ID``, and the
last one states ``WARC-Segment-Total-Length``.  Of equal payloads of at least
``revisit_from`` bytes the record with the smallest id holds the payload, the
others are ``revisit`` records without one.  Which they are is decided by digest: rows are
grouped by it with a map-side minimum, so a payload that a third of all pages
share is no hot group.

An archive is a sequence of records, stored as rows of (file, block, data)
where a row holds whole records and is at most ``BLOCK_BYTES`` long or holds a
single record.  Rows are read by Spark, so any store that Spark reads will do.

**Reading.**  Records are parsed from the blocks, segments are grouped by the
origin's id and ordered by number, the total length is verified, and the
chunked framing is decoded.  Segments of one record are bounded by that one
record's size, never by a group of records.

Defined cases: null html is an empty payload; rows that repeat page_id and
payload are all responses or all revisits; a null page_id is an empty
WARC-Page-Id and is read back as null, and holds a payload only when no row of
its group has an id; an empty table gives no records; other columns are never
looked at; a record that is cut short, lacks a segment or has a wrong length
or digest fails the read with its id.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .tables import materialise

SEGMENT_BYTES = 16 << 10  # ordinary pages exceed it, so that segments are no rare case
CHUNK_BYTES = 1 << 15
BLOCK_BYTES = 4 << 20
# Fixed value: the date that all records bear, so that reruns agree.
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    out = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes:
    """The payload of a chunked body; fails when it is not complete."""
    out, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        if framed[end + 2 + size:end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(framed[end + 2:end + 2 + size])
        at = end + 4 + size


def header_text(value: str) -> str:
    """A url as it may stand in a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def records_of(row_id: int, page_id: int | None, url: str | None, html: bytes, digest: str, original: int | None, segment: int) -> list[bytes]:
    """The records of one page; ``original`` is the page that a revisit refers to."""
    name = f"<urn:page:{row_id}>"
    head = [("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", header_text(url or "")), ("WARC-Page-Id", "" if page_id is None else str(page_id)),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(len(html)))]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if original is not None:
        profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        return [record([("WARC-Type", "revisit"), *head, profile, ("WARC-Refers-To", f"<urn:page-id:{original}>")], http)]
    block = http + chunked(html)
    if len(block) <= segment:
        return [record([("WARC-Type", "response"), *head], block)]
    parts = [block[at:at + segment] for at in range(0, len(block), segment)]
    out = [record([("WARC-Type", "response"), *head, ("WARC-Segment-Number", "1")], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{row_id}:{number}>"), ("WARC-Date", DATE),
               ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(number))]
        if number == len(parts):
            own.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record(own, part))
    return out


def payload_rows(pages: DataFrame) -> DataFrame:
    """row_id (unique, names the record), page_id, url and html as bytes."""
    return pages.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))


def originals(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """digest and the page that holds it, for digests that more than one row has."""
    keyed = payload_rows(pages).filter(F.octet_length("html") >= revisit_from).select(F.sha1("html").alias("digest"), "page_id")
    first = F.min(F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id"))
    held = keyed.groupBy("digest").agg(first.alias("first"), F.count("*").alias("n")).filter("n > 1")
    return materialise(held.select(F.col("digest").alias("_digest"), F.col("first.page_id").alias("first")), "originals")


def write_archive(pages: DataFrame, path: str, revisit_from: int = 0, segment: int = SEGMENT_BYTES) -> None:
    """Writes the pages as archive rows under ``path``."""
    held = originals(pages, revisit_from)
    repeats = F.col("_digest").isNotNull() & (F.octet_length("html") >= revisit_from) & ~F.col("first").eqNullSafe(F.col("page_id"))
    rows = payload_rows(pages).withColumn("_sha", F.sha1("html")).join(held, F.col("_sha") == F.col("_digest"), "left").select(
        "row_id", "page_id", "url", "html", F.when(repeats, F.col("first")).alias("original"))

    def pack(batches):
        for batch in batches:
            block, size, out = [], 0, []
            for r in batch.itertuples():
                page_id = None if pd.isna(r.page_id) else int(r.page_id)
                original = None if pd.isna(r.original) else int(r.original)
                for data in records_of(r.row_id, page_id, r.url, r.html, payload_digest(r.html), original, segment):
                    if block and size + len(data) > BLOCK_BYTES:
                        out.append(b"".join(block))
                        block, size = [], 0
                    block.append(data)
                    size += len(data)
            if block:
                out.append(b"".join(block))
            yield pd.DataFrame({"data": out})

    rows.withColumns({c: F.col(c).cast("decimal(20,0)").cast("string") for c in ("page_id", "original")}).mapInPandas(pack, "data binary").write.option(
        "compression", "zstd").parquet(path)


def parse_records(data: bytes):
    """(fields, block) of each record in a block of archive data."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(fields["Content-Length"])
        body = data[end + 4:end + 4 + size]
        if len(body) != size or data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut short")
        yield fields, body
        at = end + 8 + size


def payload_of(block: bytes) -> bytes:
    """The payload of a complete HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


RECORD_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, "
                 "origin string, number int, total long")


def _page_row(fields: dict[str, str], payload: bytes | None) -> tuple:
    digest, stated = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"])
    if payload is not None and (len(payload) != stated or payload_digest(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} has another payload than it states")
    to = re.search(r"<urn:page-id:(-?\d+)>", fields.get("WARC-Refers-To", ""))
    page_id = fields.get("WARC-Page-Id") or None
    return (page_id and int(page_id), fields["WARC-Target-URI"], stated, digest, fields["WARC-Type"], int(to[1]) if to else None, payload, None, None, None)


def _read_blocks(batches):
    columns = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    for batch in batches:
        out = []
        for data in batch.data:
            for fields, block in parse_records(data):
                number = fields.get("WARC-Segment-Number")
                if number is None:
                    out.append(_page_row(fields, payload_of(block) if fields["WARC-Type"] == "response" else None))
                else:
                    origin = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"])
                    # a first segment keeps its header for the record that it opens
                    header = "\r\n".join(f"{k}: {v}" for k, v in fields.items()) if number == "1" else None
                    total = fields.get("WARC-Segment-Total-Length")
                    out.append((None, header, None, None, fields["WARC-Type"], None, block, origin, int(number), total and int(total)))
        frame = pd.DataFrame(out, columns=columns)
        yield frame.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to", "number", "total")})


def joined_segments(origin: str, numbers: list[int], headers: list[str | None], blocks: list[bytes], totals: list[int | None]) -> tuple:
    """The page row of a segmented record; fails when a segment is missing or the length is wrong."""
    order = sorted(range(len(numbers)), key=numbers.__getitem__)
    block = b"".join(bytes(blocks[i]) for i in order)
    stated = [t for t in totals if t is not None and not pd.isna(t)]
    if [numbers[i] for i in order] != list(range(1, len(numbers) + 1)) or len(stated) != 1 or int(stated[0]) != len(block):
        raise ValueError(f"record {origin} has missing or repeated segments or a wrong length")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in headers[order[0]].split("\r\n"))
    return _page_row(fields, payload_of(block))


def _join_group(batches):
    columns = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    for batch in batches:
        out = []
        for r in batch.itertuples():
            parts = list(r.segments)
            out.append(joined_segments(r.origin, [p["number"] for p in parts], [p["url"] for p in parts], [p["payload"] for p in parts], [p["total"] for p in parts]))
        frame = pd.DataFrame(out, columns=columns)
        yield frame.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to", "number", "total")})


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload (null for revisits) of every page."""
    read = spark.read.schema("data binary").parquet(path).mapInPandas(_read_blocks, RECORD_SCHEMA)
    segments = read.filter("origin IS NOT NULL").groupBy("origin").agg(
        F.collect_list(F.struct("number", "url", "payload", "total")).alias("segments"))
    whole = segments.mapInPandas(_join_group, RECORD_SCHEMA)
    return read.filter("origin IS NULL").unionByName(whole).drop("origin", "number", "total")


def archived_pages(pages: DataFrame, revisit_from: int = 0, segment: int = SEGMENT_BYTES) -> DataFrame:
    """The pages after a round trip through an archive in the shared folder."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages, path, revisit_from, segment)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


