"""WARC archives: a writer, and a splittable reader of gzip-per-record files.

Each record is a gzip member of its own. A reading task gets a byte range of a file and owns
the records that start inside it. It scans the range for the gzip magic and validates each
candidate by decoding the member's start: a record begins with a WARC version line. From the
first record on it follows the chain of members, to the last record that starts in the
range, wherever that ends. (The magic can't appear in a stored block of UTF-8 text, as its
second byte continues no character.) Files lie below ``spark.checkpoint.dir``; a file
appears only when complete, under its task attempt's name, and only listed files are read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import batches_of, stored, text_batches, text_or_empty
from tripmart.llm.files import NewFile, opened
from tripmart.session import scratch_dir

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
#: Bytes of a reading task's range, and of one read.
RANGE_BYTES, READ_BYTES = 8 << 20, 1 << 20
#: Uncompressed bytes that a record's header may take.
HEADER_BYTES = 64 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(hex_sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_sha1)).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(record_id: str | None) -> int | None:
    name = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One gzip member: a response with its payload, or a revisit of page ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (b"" if revisit else payload)
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else _record_id(page_id)[1:-1],
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(body)),
    }
    if revisit:
        head |= {"WARC-Refers-To": _record_id(first), "WARC-Profile": PROFILE}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n") + pack.flush()


MANIFEST = pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())])


def write_warc(
    pages: DataFrame, folder: str | None = None, least_bytes: int = 0, page_id: str = "page_id",
    url: str = "url", html: str = "html",
) -> DataFrame:
    """Write a record per row of ``pages``; returns the manifest ``path, size, records``.

    The payload is the html in UTF-8 (null: empty). Of records with equal payloads of at
    least ``least_bytes`` bytes, those with the largest id are responses and the others
    revisit it; a null id is smaller than any, and rows that repeat the largest id are
    responses all. A null url becomes the record's id. An empty table gives no file."""
    spark = pages.sparkSession
    text_batches(spark)
    folder = folder or scratch_dir(spark, "warc")
    payload = text_or_empty(html)
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        payload.cast("binary").alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"),
    )
    first = rows.where(F.octet_length("payload") >= least_bytes).groupBy("sha1").agg(
        F.max("page_id").alias("first"), F.lit(True).alias("grouped")
    )
    keyed = rows.join(first, "sha1", "left").select(
        "page_id", "url", "payload", "sha1", "first",
        (F.coalesce("grouped", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get(), 0
        first_batch = next(batches, None)
        while first_batch is not None and not len(first_batch):
            first_batch = next(batches, None)
        if first_batch is None:
            return
        uri = f"{folder}/pages-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        with NewFile(uri) as out:
            batch = first_batch
            while batch is not None:
                for page, target, data, sha1, of, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out.write(record(page, target, data, base32_sha1(sha1), of, again))
                    n += 1
                batch = next(batches, None)
        yield from batches_of([(uri, out.size, n)], MANIFEST)

    return stored(keyed.mapInArrow(run, "path string, size long, records long"), "warc-manifest")


class Window:
    """A file's bytes from a place on, read as they are asked for."""

    def __init__(self, file, at: int, size: int):
        self.file, self.base, self.size, self.data = file, at, size, b""

    def need(self, end: int) -> bool:
        """Have the bytes up to ``end``, or all there are; were there that many?"""
        have = self.base + len(self.data)
        if end > have:
            n = min(max(end - have, READ_BYTES), self.size - have)
            if n > 0:
                self.data += self.file.read_at(n, have)
        return self.base + len(self.data) >= end

    def drop(self, at: int) -> None:
        if at - self.base > READ_BYTES:
            self.data, self.base = self.data[at - self.base :], at


def _begins_record(window: Window, at: int) -> bool:
    """Does a gzip member that starts here decode to a WARC record?"""
    window.need(at + HEADER_BYTES)
    unpack = zlib.decompressobj(31)
    try:
        return unpack.decompress(window.data[at - window.base : at - window.base + HEADER_BYTES], 16).startswith(VERSION)
    except zlib.error:
        return False


def _member(window: Window, at: int) -> tuple[bytes, int]:
    """The member at a place, uncompressed and checked against its CRC, and the next one's."""
    unpack, out, pos = zlib.decompressobj(31), [], at
    while not unpack.eof:
        if not window.need(pos + 1):
            raise ValueError(f"the file ends inside the member at {at}")
        part = window.data[pos - window.base :][:READ_BYTES]
        out.append(unpack.decompress(part))
        pos += len(part) - len(unpack.unused_data)
    return b"".join(out), pos


def records_in(uri: str, begin: int, end: int) -> Iterator[bytes]:
    """The records of a file that start at a byte in [begin, end), whole."""
    store, path = opened(uri)
    with store.open_input_file(path) as file:
        size = file.size()
        window, at = Window(file, begin, size), begin
        while at < min(end, size):  # the first candidate that is a record
            window.need(at + READ_BYTES)
            k = window.data.find(MAGIC, at - window.base)
            if k < 0:
                at = max(at + 1, window.base + len(window.data) - len(MAGIC) + 1)
                window.drop(at)
                continue
            at = window.base + k
            if at < end and _begins_record(window, at):
                break
            at += 1
        while at < min(end, size):
            data, after = _member(window, at)
            yield data
            at = after
            window.drop(at)


def parsed(data: bytes) -> dict:
    """Named fields (lower case) of a record, its HTTP fields and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    body = rest[: int(fields["content-length"])]
    if rest[len(body) :] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} doesn't end where its length says")
    http, _, payload = body.partition(b"\r\n\r\n")
    answers = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return fields | {"http": {k.lower(): v for k, v in answers.items()}, "payload": payload}


_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
)


def read_warc(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the manifest's files: ``page_id, url, record_type, payload`` (null for
    a revisit), ``payload_bytes, payload_digest`` (of the full payload) and ``refers_to``.

    A response whose payload isn't what its digest says fails the read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for uri, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield from (row(parsed(data)) for data in records_in(uri, begin, end))

        def row(r: dict) -> tuple:
            digest, revisit = r["warc-payload-digest"].removeprefix("sha1:"), r["warc-type"] == "revisit"
            if not revisit and base32_sha1(hashlib.sha1(r["payload"]).hexdigest()) != digest:
                raise ValueError(f"payload of {r['warc-record-id']} isn't what its digest says")
            return (
                _page_of(r["warc-record-id"]), r["warc-target-uri"], r["warc-type"],
                None if revisit else r["payload"], int(r["http"]["content-length"]), digest,
                _page_of(r.get("warc-refers-to")),
            )

        yield from batches_of(rows(), _RECORDS, 256)

    begin: Column = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long")))
    ranges = manifest.where("size > 0").select("path", begin.alias("begin"))
    ranges = ranges.withColumn("end", F.col("begin") + range_bytes)
    spread = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "begin")
    ddl = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
    return spread.mapInArrow(run, ddl)
