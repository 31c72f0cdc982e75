from __future__ import annotations

import io
import struct

import pyarrow.fs
import pytest
import zstandard
from pyspark.sql import functions as F

from ticklake.llm import warc_archives as op

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    groups: dict[str, list] = {}
    for page, _, html in rows:
        groups.setdefault(html or "", []).append(page)
    out = []
    for page, _, html in rows:
        largest = max((p for p in groups[html or ""] if p is not None), default=None)
        payload = (html or "").encode()
        refers = None if page == largest else largest
        out.append(
            (page, len(payload), op.payload_digest(payload), "response" if refers is None else "revisit", refers)
        )
    return sorted(out, key=str)


ROWS = [
    (1, "http://a", "<p>one</p>"),
    (5, "http://b", "<p>one</p>"),
    (3, None, "<p>one</p>"),
    (2, "http://c\r\nX: y", None),
    (4, "", ""),
    (None, "http://d", "<p>one</p>"),
    (None, "http://e", "alone"),
    (7, "http://f", "é\r\n\r\n" * 50_000),
    (-8, "http://g", "negative"),
    (9, "http://h", "twice"),
    (9, "http://h", "twice"),
]


def test_round_trip_equals_brute_force(spark, tmp_path):
    rows = ROWS + [(100 + i, f"http://x/{i}", f"<html>page {i % 90}</html>") for i in range(400)]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", path int, payload int").repartition(4)
    found = op.page_records(pages, f"file://{tmp_path}/out", limit=20_000)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert op.page_records(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/none").collect() == []


def test_payloads_come_back(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    archives = op.write_archives(pages, f"file://{tmp_path}/kept", least=1)
    records = op.read_archives(archives).collect()
    kept = {r.payload.decode() for r in records if r.record_type == "response"}
    assert kept == {html or "" for _, _, html in ROWS}
    # payloads below the least length are all responses
    assert all(r.record_type == "response" for r in records if r.payload_bytes == 0)
    assert sum(r.records for r in archives.collect()) == len(ROWS)


def test_as_many_reading_tasks_as_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op, "SAMPLE_BYTES", 5000)
    pages = spark.range(200).selectExpr("id AS page_id", "'http://x' AS url", "array_join(transform(sequence(1, 40), i -> sha2(cast(id * 100 + i AS string), 512)), ' ') AS html")
    archives = op.write_archives(pages, f"file://{tmp_path}", limit=5000)
    n = archives.count()
    read = op.read_archives(archives, payloads=False).withColumn("task", F.spark_partition_id())
    tasks = read.groupBy("path").agg(F.countDistinct("task").alias("tasks"), F.first("task").alias("task")).collect()
    assert n > 8 and len(tasks) == n and all(r.tasks == 1 for r in tasks)
    assert len({r.task for r in tasks}) == n and read.count() == 200


def archive(tmp_path, records) -> bytes:
    writer = op.ArchiveWriter(f"file://{tmp_path}")
    done = [row for record in records for row in writer.add(record)] + list(writer.finish())
    files, path = pyarrow.fs.FileSystem.from_uri(done[0][0])
    with files.open_input_stream(path, compression=None) as stream:
        return stream.read()


def record(number: int, payload: bytes) -> bytes:
    return op.record_bytes(op.record_urn(number), "http://x", payload, op.payload_digest(payload), None)


def read(content: bytes) -> list[dict]:
    return [op.parse_record(c, "here") for _, c in op.frames(io.BytesIO(content), "here")]


def test_dictionary_leads_and_frames_stand_alone(tmp_path):
    payloads = [f"<html><body>shared words and markup {i} {i * 7}</body></html>".encode() * 3 for i in range(2000)]
    content = archive(tmp_path, [record(i, p) for i, p in enumerate(payloads)])
    magic, size = struct.unpack("<II", content[:8])
    assert magic == op.DICTIONARY_MAGIC and size > 0
    assert [r["payload"] for r in read(content)] == payloads
    offsets = [offset for offset, _ in op.frames(io.BytesIO(content), "here")]
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(content[8 : 8 + size]))
    alone = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(content[offsets[9] : offsets[10]])
    assert op.parse_record(alone, "here")["payload"] == payloads[9]


def test_broken_archives_are_refused(tmp_path):
    content = archive(tmp_path, [record(i, b"payload %d" % i) for i in range(5)])
    for broken in (content[:4], content[:-3], b"\x00" * 8 + content[8:], content + b"junk"):
        with pytest.raises(op.BrokenArchive):
            read(broken)
    with pytest.raises(op.BrokenArchive):
        list(op.frames(io.BytesIO(content), "here", limit=20))


@pytest.mark.parametrize(
    ("old", "new"),
    [
        (b"WARC/1.1", b"WARC/9.9"),
        (b"WARC-Date: ", b"WARC-Dote: "),
        (b"Content-Length: ", b"Content-Length: 1"),
        (b"payload", b"paYload"),
        (b"WARC-Type: response", b"WARC-Type: revisit"),
        (b"WARC-Type: response", b"no colon"),
    ],
)
def test_broken_records_are_refused(old, new):
    with pytest.raises(op.BrokenArchive):
        op.parse_record(record(1, b"payload").replace(old, new), "here")


@pytest.mark.parametrize("number", [0, 1, -1, 2**63 - 1, -(2**63), None])
def test_record_ids_name_pages(number):
    assert op.urn_number(op.record_urn(number)) == number
