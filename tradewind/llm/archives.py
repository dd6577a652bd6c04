"""Legacy archive records to WARC, as a Spark job.

ARC, the predecessor of WARC, describes each record by one header line whose fields depend
on the version that the first record of an archive (the version block) states. The converter
reads header lines and declared lengths, and makes for each record the WARC headers that
stand for the same facts: an identifier, a timestamp, a type, and digests.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import scratch_path, ship, small_or_shuffled, stored

ship(__name__)

# Fields of a header line by version. Fixed values of the ARC format.
FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}
ENDING = b"\r\n\r\n"
MIN_REVISIT_BYTES = 100
# A WARC file takes records up to so many bytes, or a single larger one; a reading task holds one file.
FILE_BYTES = 32 << 20
# A batch becomes one ARC archive of at most so many bytes, or a single larger record.
ARCHIVE_BYTES = 8 << 20
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tradewind:archives")
DATE = "20000101000000"


@dataclass(frozen=True)
class ArcRecord:
    fields: dict[str, str]
    body: bytes
    version: int = 1
    http: dict[str, str] = field(default_factory=dict)


def arc_version_block(version: int, name: str) -> bytes:
    """First record of an archive; its body states the version and the names of the fields."""
    names = "URL IP-address Archive-date Content-type " + (
        "" if version == 1 else "Result-code Checksum Location Offset Filename ") + "Archive-length"
    body = f"{version} 0 tradewind\n{names}\n".encode()
    rest = "" if version == 1 else f" 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {DATE} text/plain{rest} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, url: str, body: bytes, *, date: str = DATE, name: str = "-") -> bytes:
    """One record: header line, body of the declared length, line end."""
    url = re.sub(r"[\s\x00-\x1f]", lambda m: "%%%02X" % ord(m[0]), url) or "-"
    rest = "" if version == 1 else f" 200 - - 0 {name}"
    return f"{url} 0.0.0.0 {date} text/html{rest} {len(body)}\n".encode() + body + b"\n"


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of one archive after its version block.

    The body is taken by its declared length, so it may hold any bytes, header lines included.
    Raises ValueError for an unknown version, a header with the wrong number of fields, or a
    body that is cut short.
    """
    version, at = None, 0
    while at < len(data):
        if data[at:at + 1] == b"\n":
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        parts = line.split(" ")
        length = int(parts[-1])
        body = data[end + 1:end + 1 + length]
        if len(body) != length:
            raise ValueError(f"record of {length} bytes ends after {len(body)}")
        at = end + 1 + length
        if version is None:
            version = int(body.split(b" ", 1)[0])
            if version not in FIELDS or not line.startswith("filedesc:"):
                raise ValueError(f"not an archive of version 1 or 2: {line[:80]}")
            continue
        names = FIELDS[version]
        if len(parts) != len(names):
            raise ValueError(f"{len(parts)} fields instead of {len(names)}: {line[:80]}")
        yield ArcRecord(dict(zip(names, parts)), body, version)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header part with its blank line, and payload, of an HTTP response."""
    if block.startswith(b"HTTP/"):
        end = block.find(ENDING)
        if end >= 0:
            return block[:end + 4], block[end + 4:]
    return b"", block


def headers_of(part: bytes) -> dict[str, str]:
    lines = part.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def record_uri(key: str, digest: str) -> str:
    """Identifier of a record: keys that come with several payloads make several."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{key}:{digest}')}>"


def warc_info(first: bytes) -> bytes:
    """The record that opens a WARC file, without the final blank lines; named after the record that follows."""
    body = b"software: tradewind\r\nformat: WARC File Format 1.1\r\n"
    lines = [
        "WARC/1.1", "WARC-Type: warcinfo",
        f"WARC-Record-ID: {record_uri('warcinfo', hashlib.sha256(first).hexdigest())}",
        f"WARC-Date: {stamped(DATE)}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(lines).encode() + ENDING + body


def stamped(date: str) -> str:
    date = date.ljust(14, "0")
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def warc_record(record: ArcRecord, key: str, original: str | None) -> bytes:
    """The WARC record of an ARC record, without the final blank lines.

    `key` names the record; its identifier is made from that and the payload's digest, so a
    repeated task writes the same bytes. With `original`, the key of a record of equal payload,
    it becomes a revisit that keeps the HTTP headers only and the digest and length of the full payload.
    """
    http, payload = split_http(record.body)
    digest = hashlib.sha256(payload).hexdigest()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: {record_uri(key, digest)}",
        f"WARC-Date: {stamped(record.fields['date'])}",
        f"WARC-Target-URI: {record.fields['url']}",
        f"WARC-IP-Address: {record.fields['ip']}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"X-Record-Key: {key}",
    ]
    block = record.body
    if original is not None:
        block = http
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_uri(original, digest)}",
            f"X-Refers-To-Key: {original}",
        ]
    lines += [
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + ENDING + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a WARC file, blocks by declared length."""
    at = 0
    while at < len(data):
        end = data.index(ENDING, at)
        headers = headers_of(data[at:end])
        length = int(headers["content-length"])
        block = data[end + 4:end + 4 + length]
        if len(block) != length or data[end + 4 + length:end + 8 + length] != ENDING:
            raise ValueError(f"broken record {headers.get('warc-record-id')}")
        yield headers, block
        at = end + 8 + length


def _http_body(key: str, payload: bytes) -> bytes:
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Record-Key: {key}\r\n\r\n"
            .encode() + payload)


def _archives(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, list[str | None]]]:
    """Archives of both versions in turn, and per record the original's key if its payload is a repeated one."""
    number, parts, size, refers = 0, [], 0, []

    def closed():
        return arc_version_block(1 + number % 2, f"{number}.arc") + b"".join(parts), refers

    for batch in batches:
        columns = [batch.column(i) for i in range(3)]
        for i in range(batch.num_rows):
            key, url, original = (c[i].as_py() for c in columns)
            payload = batch.column(3)[i].as_buffer()
            payload = payload.to_pybytes() if payload is not None else b""
            parts.append(arc_record(1 + number % 2, url or "", _http_body(key, payload)))
            size += len(parts[-1])
            refers.append(original)
            if size >= ARCHIVE_BYTES:
                yield closed()
                number, parts, size, refers = number + 1, [], 0, []
    if parts:
        yield closed()


def _convert(file_bytes: int):
    """Archives to WARC files: each row holds the records of one file, without the last blank lines."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def closed():
            return pa.RecordBatch.from_arrays(
                [pa.array([ENDING.join([warc_info(held[0]), *held])], pa.binary())], ["records"])

        for archive, refers in _archives(batches):
            for record, original in zip(parse_arc(archive), refers, strict=True):
                key = headers_of(split_http(record.body)[0])["x-record-key"]
                made = warc_record(record, key, original)
                if held and size + len(made) > file_bytes:
                    yield closed()
                    held, size = [], 0
                held.append(made)
                size += len(made)
        if held:
            yield closed()

    return run


def payload_digest() -> Column:
    return F.unhex(F.sha2(F.col("html").cast("binary"), 256))


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, original) of every page whose payload equals that of a page with a smaller id.

    Only digests are shuffled, one row per digest and task; payloads stay where they are. A
    payload that a third of the pages share is one key of that aggregation; in the join with
    its pages AQE splits it.
    """
    digests = stored(
        pages.where((F.octet_length("html") >= MIN_REVISIT_BYTES) & F.col("page_id").isNotNull())
        .select("page_id", payload_digest().alias("digest")), "digests")
    first = digests.groupBy("digest").agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
    return digests.join(first.where("n > 1"), "digest").where("page_id <> original").select(
        "page_id", "digest", F.col("original").cast("string").alias("original")).distinct()


def pages_to_warc(pages: DataFrame, folder: str, *, file_bytes: int = FILE_BYTES) -> None:
    """Writes one WARC record per row of (page_id, url, html) into files of a folder.

    The pages pass through ARC archives of both versions and the converter. Spark's own writer
    puts the bytes down, so retries and lost executors leave no half file, on any file system
    Spark reaches: a text line, here a whole file, is written as its raw bytes, and the line end is
    the blank lines that end a WARC record. A file holds a warcinfo record and up to `file_bytes`
    of records, or one larger record. A null html is an empty payload, a null url becomes "-"; a null
    page_id gives the key "null" and is never a revisit. Rows that repeat a page_id with one
    payload are all written, under one record identifier; none revisits itself. Rows that repeat one
    with different payloads each go by their own payload and identifier.
    """
    found = small_or_shuffled(stored(revisits(pages), "revisits"))
    long = F.octet_length("html") >= MIN_REVISIT_BYTES
    rows = pages.select("page_id", "url", "html", F.when(long, payload_digest()).alias("digest")).join(
        found, ["page_id", "digest"], "left").select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("key"), "url", "original",
        F.col("html").cast("binary").alias("payload"))
    files = rows.mapInArrow(_convert(file_bytes), "records binary")
    files.select(F.col("records").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "maxRecordsPerFile", 1).text(folder)


def _entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            for headers, block in parse_warc(batch.column(0)[i].as_py()):
                kind = headers["warc-type"]
                if kind == "warcinfo":
                    continue
                length, digest = int(headers["x-payload-length"]), headers["warc-payload-digest"].removeprefix("sha256:")
                if kind == "response":
                    payload = split_http(block)[1]
                    if (len(payload), hashlib.sha256(payload).hexdigest()) != (length, digest):
                        raise ValueError(f"payload differs from its digest: {headers['warc-record-id']}")
                rows.append((headers["x-record-key"], length, digest, kind, headers.get("x-refers-to-key")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 5,
             (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))],
            ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_warc(spark, folder: str) -> DataFrame:
    """Records of a folder's WARC files: key, payload length and digest, type, and what it refers to.

    Every response's payload is checked against its digest.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(
        _entries, "key string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes the pages as WARC into the shared folder and reads the archives back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    pages_to_warc(pages, folder)
    return read_warc(spark, folder).select(
        F.when(F.col("key") != "null", F.col("key")).cast("long").alias("page_id"),
        "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), f AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS original FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM original OR page_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM f
"""
