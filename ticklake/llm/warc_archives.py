"""WARC archives compressed with Zstandard: written and read as Spark jobs.

An archive begins with a skippable frame that holds the dictionary; each record is a frame of
its own, so any record can be reached by its offset. The reader loads the dictionary from the
leading frame, decodes one frame at a time, and checks each record's headers and lengths.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import record_batch, sliced, stored
from ticklake.scratch import new_folder

#: Fixed values of the format: magic number of the dictionary's skippable frame, and of a frame.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528

#: Fixed value: profile of a revisit of an equal payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payload bytes after which a writer starts another archive, and those its dictionary is made of.
ARCHIVE_BYTES = 64 << 20
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10

#: Longest decoded record that the reader accepts by default.
RECORD_BYTES = 1 << 30

WRITTEN = "path string, records long, bytes long"
RECORDS = (
    "path string, offset long, record_id string, record_type string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, refers_to string, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(number: int | None) -> str:
    """The record id of a page; pages without an id share the highest one."""
    return f"<urn:uuid:{uuid.UUID(int=(1 << 128) - 1 if number is None else number & (1 << 64) - 1)}>"


def urn_number(urn: str | None) -> int | None:
    """The page a record id stands for."""
    if urn is None:
        return None
    number = uuid.UUID(urn.strip("<>").rpartition(":")[2]).int
    if number >> 64:
        return None
    return number - (1 << 64) if number >> 63 else number


def record_bytes(
    urn: str, uri: str, payload: bytes, digest: str, refers_to: str | None, date: str = "1970-01-01T00:00:00Z"
) -> bytes:
    """One record; a revisit keeps the HTTP headers and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", urn),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
    ]
    if refers_to is not None:
        headers += [("WARC-Refers-To", refers_to), ("WARC-Profile", REVISIT_PROFILE)]
    headers.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def trained_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for the records, empty where there are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class ArchiveWriter:
    """Records into numbered archives below a folder; each gets its own dictionary.

    An archive is written under a name of this attempt and listed only when it is complete,
    so what a failed or doubled attempt leaves behind is never read.
    """

    def __init__(self, folder: str, limit: int = ARCHIVE_BYTES) -> None:
        self.files, self.folder = pyarrow.fs.FileSystem.from_uri(folder)
        self.files.create_dir(self.folder, recursive=True)
        self.uri, self.limit = folder.rstrip("/"), limit
        self.attempt, self.number = uuid.uuid4().hex, 0
        self.waiting: list[bytes] = []
        self.held = 0
        self.out = None

    def add(self, record: bytes) -> Iterator[tuple[str, int, int]]:
        if self.out is None:
            self.waiting.append(record)
            self.held += len(record)
            if self.held >= SAMPLE_BYTES:
                self._open()
        else:
            self._write(record)
        if self.out is not None and self.raw >= self.limit:
            yield self._close()

    def finish(self) -> Iterator[tuple[str, int, int]]:
        if self.waiting:
            self._open()
        if self.out is not None:
            yield self._close()

    def _open(self) -> None:
        self.name = f"part-{self.attempt}-{self.number:05d}.warc.zst"
        self.number += 1
        self.out = self.files.open_output_stream(f"{self.folder.rstrip('/')}/{self.name}", compression=None)
        self.raw = self.records = self.size = 0
        dictionary = trained_dictionary([record[:4096] for record in self.waiting])
        frame = zstandard.ZstdCompressor().compress(dictionary) if dictionary else b""
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(frame)) + frame)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.packer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True)
        waiting, self.waiting, self.held = self.waiting, [], 0
        for record in waiting:
            self._write(record)

    def _put(self, content: bytes) -> None:
        self.out.write(content)
        self.size += len(content)

    def _write(self, record: bytes) -> None:
        self._put(self.packer.compress(record))
        self.raw += len(record)
        self.records += 1

    def _close(self) -> tuple[str, int, int]:
        self.out.close()
        self.out = None
        return f"{self.uri}/{self.name}", self.records, self.size


def _write_batches(batches: Iterator[pa.RecordBatch], folder: str, limit: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
    writer = ArchiveWriter(folder, limit)
    done: list[tuple[str, int, int]] = []
    for batch in sliced(batches, "payload", 1 << 24):
        for row in batch.to_pylist():
            revisit = row["response"] is not None and row["response"] != row["page_id"]
            payload = row["payload"].encode()
            record = record_bytes(
                record_urn(row["page_id"]),
                row["uri"],
                payload,
                payload_digest(payload),
                record_urn(row["response"]) if revisit else None,
            )
            done += writer.add(record)
    done += writer.finish()
    yield record_batch(schema, *([row[i] for row in done] for i in range(3)))


def write_archives(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 0,
    limit: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Archives of all rows below ``folder``, and (path, records, bytes) of each.

    Of rows with equal payloads of at least ``least`` bytes the one with the largest id is a
    response, the others revisit it. Payload groups meet as digests and ids only; a group
    with very many rows is a skewed join key, which adaptive execution splits.
    Defined cases: a null payload is empty, a null url an empty URI; control characters in a url become
    spaces; rows that repeat the largest id are all responses; a row without id revisits its group's largest id.
    """
    rows = pages.select(
        pages[id].cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(pages[url], F.lit("")), r"[\x00-\x1F]+", " ").alias("uri"),
        F.coalesce(pages[payload], F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2(F.col("payload"), 256))
    responses = rows.groupBy("digest").agg(F.max("page_id").alias("largest"))
    linked = rows.join(responses, "digest").select(
        "page_id",
        "uri",
        "payload",
        F.when(F.octet_length("payload") >= least, F.col("largest")).alias("response"),
    )
    return stored(linked.mapInArrow(partial(_write_batches, folder=folder, limit=limit), WRITTEN), "archives")


class BrokenArchive(ValueError):
    """An archive or record that breaks the format; names the path and offset."""


def _exactly(stream, size: int, where: str) -> bytes:
    content = stream.read(size)
    if len(content) != size:
        raise BrokenArchive(f"{where}: ends {size - len(content)} bytes early")
    return content


def _dictionary(stream, where: str) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of the leading frame, and the frame's length."""
    magic, size = struct.unpack("<II", _exactly(stream, 8, where))
    if magic != DICTIONARY_MAGIC:
        raise BrokenArchive(f"{where}: no dictionary frame")
    content = _exactly(stream, size, where)
    if content[:4] == struct.pack("<I", FRAME_MAGIC):
        content = zstandard.ZstdDecompressor().decompress(content, max_output_size=64 << 20)
    return zstandard.ZstdCompressionDict(content) if content else None, 8 + size


def frames(stream, where: str, limit: int = RECORD_BYTES) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded content) of each frame behind the dictionary, one at a time."""
    dictionary, offset = _dictionary(stream, where)
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    waiting = stream.read(1 << 20)
    while waiting:
        machine = unpacker.decompressobj()
        parts, size, start = [], 0, offset
        while True:
            try:
                part = machine.decompress(waiting)
            except zstandard.ZstdError as problem:
                raise BrokenArchive(f"{where} at {start}: {problem}") from problem
            parts.append(part)
            size += len(part)
            if size > limit:
                raise BrokenArchive(f"{where} at {start}: a record of more than {limit} bytes")
            rest = machine.unused_data
            offset += len(waiting) - len(rest)
            if machine.eof:
                break
            waiting = stream.read(1 << 20)
            if not waiting:
                raise BrokenArchive(f"{where} at {start}: the last frame is cut off")
        yield start, b"".join(parts)
        waiting = rest or stream.read(1 << 20)


def parse_record(content: bytes, where: str) -> dict:
    """Headers and payload of one record, after checking version, required headers and lengths."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise BrokenArchive(f"{where}: no WARC header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise BrokenArchive(f"{where}: header line without a colon")
        headers[name.decode().strip().lower()] = value.decode().strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - headers.keys()
    if missing:
        raise BrokenArchive(f"{where}: no {', '.join(sorted(missing))}")
    length = headers["content-length"]
    if not length.isdecimal() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BrokenArchive(f"{where}: Content-Length {length} but {len(rest) - 4} bytes")
    block = rest[:-4]
    if "warc-block-digest" in headers and headers["warc-block-digest"] != f"sha1:{payload_digest(block)}":
        raise BrokenArchive(f"{where}: the block's digest differs")
    http, found, payload = block.partition(b"\r\n\r\n")
    size = None
    for line in http.split(b"\r\n")[1:]:
        if line.lower().startswith(b"content-length:"):
            size = int(line.partition(b":")[2])
    kind = headers["warc-type"]
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response" and (size not in (None, len(payload)) or digest not in (None, payload_digest(payload))):
        raise BrokenArchive(f"{where}: the payload's length or digest differs")
    if kind == "revisit" and "warc-refers-to" not in headers:
        raise BrokenArchive(f"{where}: a revisit of nothing")
    return {
        "record_id": headers["warc-record-id"],
        "record_type": kind,
        "target_uri": headers.get("warc-target-uri"),
        "date": headers["warc-date"],
        "payload_digest": digest,
        "payload_bytes": size if size is not None else len(payload),
        "refers_to": headers.get("warc-refers-to"),
        "payload": payload if kind != "revisit" else None,
    }


READ = pa.schema(
    [("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string())]
    + [("target_uri", pa.string()), ("date", pa.string()), ("payload_digest", pa.string())]
    + [("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())]
)


def _read_batches(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            files, path = pyarrow.fs.FileSystem.from_uri(uri)
            rows, held = [], 0
            with files.open_input_stream(path, compression=None) as stream:
                for offset, content in frames(stream, uri):
                    row = parse_record(content, f"{uri} at {offset}")
                    if not payloads:
                        row["payload"] = None
                    rows.append({"path": uri, "offset": offset} | row)
                    held += len(row["payload"] or b"") + 500
                    if held >= 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, schema=READ)
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=READ)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in ``path``, each read as a stream, in as many tasks as there are archives.

    A broken archive or record fails the job with its path and offset.
    """
    paths = archives.select("path")
    # a number that is given is kept; Spark would join tasks that read a few bytes of paths each
    paths = paths.repartitionByRange(max(paths.count(), 1), "path")
    return paths.mapInArrow(partial(_read_batches, payloads=payloads), RECORDS)


def page_records(pages: DataFrame, folder: str | None = None, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all pages after a
    round trip through archives below ``folder``, or below the shared folder."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    folder = folder if ":" in folder.split("/")[0] else f"file://{folder}"
    records = read_archives(write_archives(pages, folder, limit=limit), payloads=False)
    return records.mapInArrow(
        _page_batches,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def _page_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("record_type", pa.string()), ("refers_to", pa.int64())]
    )
    for batch in batches:
        yield record_batch(
            schema,
            [urn_number(urn) for urn in batch.column("record_id").to_pylist()],
            batch.column("payload_bytes"),
            batch.column("payload_digest"),
            batch.column("record_type"),
            [urn_number(urn) for urn in batch.column("refers_to").to_pylist()],
        )
