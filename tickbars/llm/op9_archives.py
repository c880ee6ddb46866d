"""Legacy archive converter: ARC files of version 1 and 2 become equivalent WARC records.

`write_arc` lands pages as ARC files: a version block, then for each page a header line and a network document of the
declared length. `read_arc` parses the header line by the version that the file declares and takes the declared number
of bytes. `write_warc` synthesises each record's identifier (a name-based UUID), timestamp, type and digests; of equal payloads of
`LEAST_BYTES` or more, the one with the largest page_id is the response and the others are revisits that refer to its record, address and
time. Each file begins with a warcinfo record.
`read_warc` reads the records back by their declared lengths and checks each response's digest against its payload.

Spark writes and reads all files, so they can be in any store. A file holds at most `FILE_RECORDS` records and `FILE_BYTES` before compression,
or one longer record; a task reads one file at a time.

Edge cases: null html is an empty payload; a null url is `about:blank`, white space in a url is percent-encoded; a null
page_id is carried as such and never the response of others; rows that repeat a page_id stay separate records (of equal
ones, each is a response); empty tables make empty archives; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.session import work_dir

LEAST_BYTES = 1000
FILE_RECORDS = 1000
FILE_BYTES = 64 << 20
#: What a task gives back at once: records, and their bytes.
BATCH, BATCH_BYTES = 200, 16 << 20
CAPTURED = "20240101000000"
#: Fixed values of the ARC format: what the version block says the fields of a header line are.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
_HTTP_END = b"\r\n\r\n"
_SPEED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
_PLACED = "value string, file int, place long"
RECORDS = "page_id long, url string, captured string, content_type string, payload binary"


def _version_block(version: int) -> str:
    body = f"{version} 0 tickbars\n{' '.join(ARC_FIELDS[version])}\n"
    line = {"URL": "filedesc://pages.arc", "IP-address": "0.0.0.0", "Archive-date": CAPTURED, "Content-type": "text/plain", "Archive-length": str(len(body))}
    return " ".join(line.get(f, "-") for f in ARC_FIELDS[version]) + "\n" + body


def _arc_record(version: int, page_id: int | None, url: str | None, html: str | None, offset: int) -> str:
    html = html or ""
    url = quote(url, safe="".join(chr(c) for c in range(33, 127))) if url else "about:blank"
    size = len(html.encode())
    head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page_id is None else page_id}\r\nContent-Length: {size}\r\n\r\n"
    line = {
        "URL": url, "IP-address": "0.0.0.0", "Archive-date": CAPTURED, "Content-type": "text/html", "Result-code": "200",
        "Offset": str(offset), "Filename": "pages.arc", "Archive-length": str(len(head) + size),
    }
    return " ".join(line.get(f, "-") for f in ARC_FIELDS[version]) + "\n" + head + html


class Files:
    """The archive files of a task, one after the other."""

    def __init__(self, records: int, size: int):
        self.most, self.longest = records, size
        self.number, self.records, self.size, self.place = -1, 0, 0, 0

    def begins(self, size: int) -> bool:
        """Whether a record of this size begins a new file."""
        new = self.number < 0 or self.records > 0 and (self.records >= self.most or self.size + size > self.longest)
        if new:
            self.number, self.records, self.size = self.number + 1, 0, 0
        self.records += 1
        self.size += size
        return new

    def placed(self, record: bytes) -> tuple[bytes, int, int]:
        self.place += 1
        return record, self.number, self.place


def _batches(placed: Iterator[tuple[bytes, int, int]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[bytes, int, int]] = []
    size = 0
    for one in placed:
        held.append(one)
        size += len(one[0])
        if len(held) >= BATCH or size >= BATCH_BYTES:
            yield _placed(held)
            held, size = [], 0
    if held:
        yield _placed(held)


def _placed(held: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    values, files, places = zip(*held)
    columns = [pa.array(values, pa.binary()).cast(pa.string()), pa.array(files, pa.int32()), pa.array(places, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["value", "file", "place"])


def _write(placed: DataFrame, path: str, between: str) -> None:
    """A folder for each number, in which each task has a file; records stay in order."""
    ordered = placed.sortWithinPartitions("file", "place").select("value", "file")
    ordered.write.options(**_SPEED, lineSep=between).partitionBy("file").text(path)


def write_arc(pages: DataFrame, path: str, file_records: int = FILE_RECORDS, file_bytes: int = FILE_BYTES) -> None:
    """Version 1 and 2 files by turns."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int, int]]:
        files, version, offset = Files(file_records, file_bytes), 2, 0
        for batch in batches:
            for page_id, url, html in zip(*map(_values, batch.columns)):
                if files.begins(len(html or "")):
                    version = 3 - version
                    block = _version_block(version).encode()
                    offset = len(block) + 1
                    yield files.placed(block)
                record = _arc_record(version, page_id, url, html, offset).encode()
                offset += len(record) + 1
                yield files.placed(record)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    _write(rows.mapInArrow(lambda batches: _batches(records(batches)), _PLACED), path, "\n")


def _values(column: pa.Array) -> Iterator:
    """One value at a time, not all of a batch as Python objects."""
    return (v.as_py() for v in column)


def _unpacked(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def _http_headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(_HTTP_END)
    fields = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in fields}, body


def arc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header line's fields, network document) of the records after the version block."""
    at, fields = 0, None
    while at < len(content):
        if content[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.index(b"\n", at)
        values = content[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        length = int(values[-1])
        block = content[end + 1 : end + 1 + length]
        if len(block) < length:
            raise ValueError(f"a record of {length} bytes ends after {len(block)}")
        if fields is None:
            version = int(block.split(b" ", 1)[0])
            fields = ARC_FIELDS[version]
        else:
            # A content type may hold spaces: what stands between the fields around it is all its own.
            extra = len(values) - len(fields)
            kind = fields.index("Content-type")
            values[kind : kind + extra + 1] = [" ".join(values[kind : kind + extra + 1])]
            yield dict(zip(fields, values)), block
        at = end + 1 + length


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """RECORDS of all files below a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                size = 0
                for line, block in arc_records(_unpacked(content.as_py())):
                    headers, payload = _http_headers(block)
                    page_id = headers.get("x-page-id", "")
                    rows.append((int(page_id) if page_id else None, line["URL"], line["Archive-date"], line["Content-type"], payload))
                    size += len(payload)
                    if len(rows) >= BATCH or size >= BATCH_BYTES:
                        yield _batch(rows, RECORDS)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, RECORDS)

    return _files(spark, path).mapInArrow(run, RECORDS)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _base32(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def record_id(page_id: int | None, url: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"


def _date(captured: str) -> str:
    return re.sub(r"(....)(..)(..)(..)(..)(..).*", r"\1-\2-\3T\4:\5:\6Z", captured)


def warc_info(file: str) -> bytes:
    """The record that begins a file and says what wrote it."""
    block = b"software: tickbars\r\nformat: WARC File Format 1.1\r\n"
    lines = [
        "WARC/1.1",
        "WARC-Type: warcinfo",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, file)}>",
        f"WARC-Date: {_date(CAPTURED)}",
        "Content-Type: application/warc-fields",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join([*lines, "", ""]).encode() + block


def warc_record(page_id: int | None, url: str, captured: str, content_type: str, payload: bytes, digest: str, refers_to: dict | None) -> bytes:
    """`refers_to`: page_id, url and captured of the response that has the payload."""
    head = f"HTTP/1.0 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, url, digest)}",
        f"WARC-Date: {_date(captured)}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: {_base32(digest)}",
        f"WARC-Block-Digest: {_base32(hashlib.sha1(block).hexdigest())}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to['page_id'], refers_to['url'], digest)}",
            f"WARC-Refers-To-Target-URI: {refers_to['url']}",
            f"WARC-Refers-To-Date: {_date(refers_to['captured'])}",
            f"X-Refers-To-Page-Id: {refers_to['page_id']}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def write_warc(records: DataFrame, path: str, least_bytes: int = LEAST_BYTES, file_records: int = FILE_RECORDS, file_bytes: int = FILE_BYTES) -> None:
    """records: RECORDS. Payloads are UTF-8."""
    records = records.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    large = records.filter(F.col("size") >= least_bytes)
    firsts = large.groupBy("digest", "size").agg(F.max(F.struct("page_id", "url", "captured")).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter("n > 1 and first.page_id is not null")
    typed = records.join(firsts.select("digest", "size", "first"), ["digest", "size"], "left")
    typed = typed.withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first.page_id")), F.col("first")))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int, int]]:
        files = Files(file_records, file_bytes)
        for batch in batches:
            for row in zip(*map(_values, batch.columns)):
                if files.begins(len(row[4])):
                    yield files.placed(warc_info(f"{TaskContext.get().partitionId()} {files.number}"))
                yield files.placed(warc_record(*row))

    rows = typed.select("page_id", "url", "captured", "content_type", "payload", "digest", "refers_to")
    _write(rows.mapInArrow(lambda batches: _batches(placed(batches)), _PLACED), path, "\r\n\r\n")


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record."""
    at = 0
    while at < len(content):
        end = content.index(_HTTP_END, at) + len(_HTTP_END)
        fields = (line.partition(":") for line in content[at:end].decode("utf-8", "replace").split("\r\n")[1:])
        headers = {name.strip().lower(): value.strip() for name, _, value in fields}
        length = int(headers["content-length"])
        if len(content) < end + length:
            raise ValueError(f"a record of {length} bytes ends after {len(content) - end}")
        yield headers, content[end : end + length]
        at = end + length + len(_HTTP_END)


ENTRIES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, captured string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """ENTRIES of all files below a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                for headers, block in warc_records(_unpacked(content.as_py())):
                    if headers["warc-type"] == "warcinfo":
                        continue
                    http, payload = _http_headers(block)
                    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                    kind = headers["warc-type"]
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{headers['warc-record-id']}: payload and digest differ")
                    ids = [int(v) if (v := headers.get(k, "")) else None for k in ("x-page-id", "x-refers-to-page-id")]
                    rows.append((ids[0], int(http["content-length"]), digest, kind, ids[1], headers["warc-record-id"], headers["warc-date"]))
                if rows:
                    yield _batch(rows, ENTRIES)

    return _files(spark, path).mapInArrow(run, ENTRIES)


def converted(pages: DataFrame) -> DataFrame:
    """Pages to ARC files, those to WARC files, and the WARC files read back."""
    spark = pages.sparkSession
    arc, warc = work_dir(spark, "arc"), work_dir(spark, "warc")
    write_arc(pages, arc)
    write_warc(read_arc(spark, arc), warc)
    return read_warc(spark, warc)


def op9_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return converted(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (SELECT payload, max(page_id) AS first FROM payloads WHERE strlen(payload) >= 1000 GROUP BY payload)
SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN first != page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first != page_id THEN first END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload)
"""
