"""WARC archives: records for web pages, and their reassembly from segments.

Writing: each page becomes one record whose payload is the html in a chunked HTTP response. Of equal
payloads only the first (by page id) is a response, the others are revisits that refer to it. A block
over the segment size is split: the first segment is the response, the others are continuation
records. Archives are gzipped files in the shared folder; the writer puts the blank lines that end
a record between rows.

Reading: archives are parsed record by record. Continuations are grouped by the identifier of their
origin, ordered by segment number, joined, checked against the total length, and the chunked transfer
framing is decoded; every payload is checked against the digest in its header.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm._common import cut, scratch_path, slices

SEGMENT_BYTES = 16_384
HTTP_CHUNK = 4096
RECORDS_PER_FILE = 250
CRLF = b"\r\n"
DATE = b"2026-01-01T00:00:00Z"
HTTP_HEAD = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Transfer-Encoding: chunked", b"", b""])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def to_chunked(payload: bytes, size: int = HTTP_CHUNK) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in parts) + b"0\r\n\r\n"


def from_chunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        out.append(body[at : at + size])
        if len(out[-1]) != size or body[at + size : at + size + 2] != CRLF:
            raise ValueError("broken chunked framing")
        at += size + 2


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return from_chunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(kind: bytes, record_id: str, fields: dict[str, object], block: bytes) -> bytes:
    """A record without the two line ends after its block."""
    lines = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <%b>" % record_id.encode(), b"WARC-Date: " + DATE]
    lines += [f"{k}: {v}".encode() for k, v in fields.items() if v is not None]
    return CRLF.join([*lines, b"Content-Length: %d" % len(block), b"", block])


def records_of(row: int, page_id: int | None, url: str | None, payload: bytes, first_id: int | None, segment_bytes: int = SEGMENT_BYTES) -> list[bytes]:
    """The records of one page: a revisit, a whole response, or a response with its continuations. row tells records apart."""
    name = f"urn:record:{row}"
    clean = None if url is None else "".join(url.split()) or None  # a header line holds no white space here
    about = {"WARC-Target-URI": clean, "X-Page-ID": page_id, "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}"}
    if page_id != first_id:
        return [_record(b"revisit", name, about | {"X-Refers-To-Page-ID": first_id, "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}, HTTP_HEAD)]
    block = HTTP_HEAD + to_chunked(payload)
    if len(block) <= segment_bytes:
        return [_record(b"response", name, about, block)]
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    made = [_record(b"response", name, about | {"WARC-Segment-Number": 1}, parts[0])]
    for n, part in enumerate(parts[1:], 2):
        total = {"WARC-Segment-Total-Length": len(block)} if n == len(parts) else {}
        made.append(_record(b"continuation", f"{name}:{n}", {"WARC-Segment-Origin-ID": f"<{name}>", "WARC-Segment-Number": n} | total, part))
    return made


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("a record must begin with its version")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a record's length doesn't match its content")
        yield fields, archive[start:stop]
        at = stop + 4


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write the records of all pages as gzipped archives under path."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    named = rows.withColumn("sha", F.unhex(F.sha1("payload"))).withColumn("size", F.length("payload"))
    firsts = named.groupBy("sha", "size").agg(F.min("page_id").alias("first_id"))
    joined = named.join(firsts, ["sha", "size"]).withColumn("row", F.monotonically_increasing_id())

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, 2 << 20):
            made = [r for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) for r in records_of(*row, segment_bytes)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])

    records = joined.select("row", "page_id", "url", "payload", "first_id").mapInArrow(make, "record binary")
    records.select(F.col("record").cast("string")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Columns: page_id, payload_bytes, payload_digest, record_type, refers_to: one row for each page."""

    names = ["kind", "record_id", "page_id", "refers_to", "digest", "segment", "total", "payload_bytes", "block"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0):  # one archive at a time
                rows = []
                for fields, block in parse(gzip.decompress(packed.as_buffer())):
                    kind, own = fields["warc-type"], fields["warc-record-id"]
                    segment = int(fields["warc-segment-number"]) if "warc-segment-number" in fields else None
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    size = None
                    if kind == "response" and segment is None:
                        payload = payload_of(block)
                        size = len(payload)
                        if base32_sha1(payload) != digest:
                            raise ValueError(f"{own}: the payload doesn't match its digest")
                    page, refers, total = (int(fields[x]) if x in fields else None for x in ("x-page-id", "x-refers-to-page-id", "warc-segment-total-length"))
                    rows.append((kind, fields.get("warc-segment-origin-id", own), page, refers, digest, segment, total, size, block if segment else None))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names)

    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = cut(files.mapInArrow(split, "kind string, record_id string, page_id long, refers_to long, digest string, segment int, total long, payload_bytes long, block binary"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for own, digest, total, parts in zip(*(c.to_pylist() for c in batch.columns[:1] + batch.columns[2:5]), strict=True):
                block = b"".join(x["block"] for x in parts)
                if [x["segment"] for x in parts] != list(range(1, len(parts) + 1)) or len(block) != total:
                    raise ValueError(f"{own}: segments are missing")
                payload = payload_of(block)
                if base32_sha1(payload) != digest:
                    raise ValueError(f"{own}: the payload doesn't match its digest")
                sizes.append(len(payload))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64())], ["record_id", "page_id", "digest", "payload_bytes"])

    segments = parsed.where("segment is not null").groupBy("record_id").agg(
        F.max("page_id").alias("page_id"), F.max("digest").alias("digest"), F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts")
    )
    whole = parsed.where("kind = 'response' and segment is null").select("record_id", "page_id", "digest", "payload_bytes")
    responses = whole.union(segments.mapInArrow(assemble, "record_id string, page_id long, digest string, payload_bytes long"))
    told = responses.select(F.col("page_id").alias("refers_to"), "digest", "payload_bytes").distinct()
    revisits = parsed.where("kind = 'revisit'").select("page_id", "refers_to", "digest").join(told, ["refers_to", "digest"], "left")
    missing = F.raise_error(F.concat(F.lit("no response with the payload of a revisit to page "), F.col("refers_to").cast("string")))
    checked = revisits.withColumn("payload_bytes", F.coalesce("payload_bytes", missing.cast("long")))
    return responses.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).union(
        checked.select("page_id", "payload_bytes", "digest", F.lit("revisit"), "refers_to")
    )


def archive_round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the archives of all pages to the shared folder and read them back; columns as read_archives().

    A null html is an empty payload; empty payloads are equal to each other. Rows that repeat an id are
    pages of their own: those with the smallest id of a payload are all responses. Pages without an id
    are responses only if no page with an id has the payload. An empty table gives no rows.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, segment_bytes, id_col=id_col, url_col=url_col, html_col=html_col)
    return read_archives(pages.sparkSession, path)
