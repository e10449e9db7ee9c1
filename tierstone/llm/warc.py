"""WARC archives with dictionary compression.

An archive begins with a skippable Zstandard frame that holds a dictionary (itself a
frame), followed by one frame for each record. The dictionary is trained on the first
records of its archive, up to ``TRAIN_BYTES``, so it needs no pass over the table, and
each archive reads on its own. Records with equal payloads are one ``response``, the one
with the largest ``page_id``, and ``revisit`` records that name it and hold the HTTP
header only. Which record that is comes from an aggregate by digest and a join, so a
payload with a third of all pages is no hot spot.

Cases: a null payload is an empty one; payloads shorter than ``min_bytes`` are responses
without a look for others. Rows that repeat the largest ``page_id`` of a payload are
responses too. A null ``page_id`` is smaller than any other; a payload that only such
rows have is a response in each. A null ``url`` leaves its header out; line breaks in one
are percent-encoded. Very long payloads are one record. An empty table gives no archive
and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_scratch
from .files import create, open_file

MIN_BYTES = 0
ARCHIVE_BYTES = 1 << 28
TRAIN_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
DICTIONARY_FRAME = 0x184D2A5D
DATE = "2025-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _page_of(record_id: str) -> int | None:
    return int(record_id[12:-1]) if record_id.startswith("<urn:x-page:") else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """The bytes of one record; a revisit if ``refers_to`` is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    head += [f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{_digest(payload)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
        block = http
    else:
        block = http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary trained on records; of their plain bytes where they are too few to train on."""
    if len(samples) >= 64:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(
        b"".join(samples)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )


class ArchiveWriter:
    """Writes records to archives below a folder, a new one every ``ARCHIVE_BYTES``."""

    def __init__(self, folder: str, archive_bytes: int = ARCHIVE_BYTES):
        self._folder, self._limit = folder, archive_bytes
        self._waiting: list[bytes] = []
        self._stream, self._size, self._count = None, 0, 0
        self.done: list[dict] = []

    def add(self, body: bytes) -> None:
        self._size += len(body)
        if self._stream is None:
            self._waiting.append(body)
            if self._size >= TRAIN_BYTES:
                self._open()
        else:
            self._stream.write(self._compressor.compress(body))
        self._count += 1
        if self._size >= self._limit:
            self.close()

    def _open(self) -> None:
        self._path, self._stream = create(self._folder, ".warc.zst")
        dictionary = build_dictionary(self._waiting)
        frame = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
        self._stream.write(struct.pack("<II", DICTIONARY_FRAME, len(frame)) + frame)
        self._compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        for body in self._waiting:
            self._stream.write(self._compressor.compress(body))
        self._waiting = []

    def close(self) -> None:
        if self._waiting:
            self._open()
        if self._stream is not None:
            self._stream.close()
            self.done.append({"path": self._path, "records": self._count})
        self._stream, self._size, self._count = None, 0, 0


def read_records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    with open_file(path) as stream:
        magic, size = struct.unpack("<II", stream.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{path} has no dictionary frame")
        body = zstandard.ZstdDecompressor().decompress(stream.read(size))
        trained = body[:4] == b"\x37\xa4\x30\xec"
        kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body, dict_type=kind))
        plain = reader.stream_reader(stream, read_across_frames=True, closefd=False)
        held = b""

        def upto(n: int) -> bytes:
            nonlocal held
            parts, have = [held], len(held)
            while have < n:
                more = plain.read(max(n - have, 1 << 16))
                if not more:
                    raise ValueError(f"{path} ends within a record")
                parts.append(more)
                have += len(more)
            joined = b"".join(parts)
            held = joined[n:]
            return joined[:n]

        while True:
            while b"\r\n\r\n" not in held:
                more = plain.read(1 << 16)
                if not more:
                    if held:
                        raise ValueError(f"{path} ends within a header")
                    return
                held += more
            head, _, held = held.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            block = upto(int(headers["Content-Length"]) + 4)[:-4]
            yield headers, block


def with_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, html, refers_to``: the response's id for each revisit, else null."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumns(
        {"digest": F.sha1("html"), "size": F.octet_length("html")}
    )
    last = (
        pages.select("page_id", html.alias("html"))
        .select("page_id", F.sha1("html").alias("digest"), F.octet_length("html").alias("size"))
        .where(F.col("size") >= min_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    is_revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.join(last, ["digest", "size"], "left").select(
        "page_id", "url", "html", F.when(is_revisit, F.col("last")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives; the manifest ``path, records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, archive_bytes)
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(i) for i in range(4)), strict=True):
                body = record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py())
                writer.add(body)
        writer.close()
        yield pa.RecordBatch.from_pylist(writer.done, schema=pa.schema([("path", "string"), ("records", "int64")]))

    return with_revisits(pages, min_bytes).mapInArrow(run, "path string, records bigint")


def read_archives(manifest: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record.

    Digests of responses are computed from the payload and held against the header.
    """
    fields = [("page_id", "int64"), ("payload_bytes", "int64"), ("payload_digest", "string"),
              ("record_type", "string"), ("refers_to", "int64")]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for headers, block in read_records(path):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = headers["WARC-Type"]
                    if kind == "response" and (len(payload) != size or _digest(payload) != digest):
                        raise ValueError(f"{path}: {headers['WARC-Record-ID']} differs from its digest")
                    target = headers.get("WARC-Refers-To")
                    rows.append(
                        {"page_id": _page_of(headers["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
                         "record_type": kind, "refers_to": _page_of(target) if target else None}
                    )
                    if len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = manifest.select("path").repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4)
    return files.mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    )


def archive(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the archives of a table of pages and read them back."""
    spark = pages.sparkSession
    base = shared_scratch(spark, "warc")
    write_archives(pages, f"{base}/archives", min_bytes).write.parquet(f"{base}/manifest")
    return read_archives(spark.read.parquet(f"{base}/manifest"))
