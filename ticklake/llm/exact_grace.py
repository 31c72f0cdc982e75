"""Exact de-duplication by Grace hashing over complete content.

Three steps. In each scan task an open-addressing table collapses equal texts, so a text
that fills a third of the table is shipped once per task and not once per row. The distinct
texts of all tasks are shuffled by a hash of their content, which is the first level of
partitioning. In each of those tasks an open-addressing table compares complete texts;
texts that find no room go to spill files by further bits of the hash, and each file is
worked off in the same way, until what is left fits the table.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import record_batch, sliced, stored, text_of

#: Bytes of text an open-addressing table holds; a longer text is held alone.
TABLE_BYTES = 64 << 20

#: Spill files per level.
FAN = 8


class ContentTable:
    """Open addressing with linear probing; entries are equal only if all bytes are."""

    def __init__(self, budget: int = TABLE_BYTES) -> None:
        self.budget = budget
        self.clear()

    def clear(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.used = 0

    def _free_slot(self, slots: list[int], hashed: int) -> int:
        mask = len(slots) - 1
        at = hashed & mask
        while slots[at] >= 0:
            at = (at + 1) & mask
        return at

    def find(self, hashed: int, content: bytes) -> int:
        """The entry with this content, or -1."""
        mask = len(self.slots) - 1
        at = hashed & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        return -1

    def has_room(self, content: bytes) -> bool:
        return not self.contents or self.used + len(content) + 100 <= self.budget

    def add(self, hashed: int, content: bytes) -> int:
        if 2 * len(self.contents) >= len(self.slots):
            wider = [-1] * (2 * len(self.slots))
            for entry, value in enumerate(self.hashes):
                wider[self._free_slot(wider, value)] = entry
            self.slots = wider
        entry = len(self.contents)
        self.slots[self._free_slot(self.slots, hashed)] = entry
        self.hashes.append(hashed)
        self.contents.append(content)
        self.used += len(content) + 100
        return entry


LOCAL = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("carrier", pa.string()),
        ("text_sha256", pa.string()),
        ("hash", pa.int64()),
        ("text", pa.string()),
    ]
)


def _local_batches(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """A row per document with its carrier; the carrier's own row also has the text."""
    from pyspark import TaskContext

    context = TaskContext.get()
    task = context.partitionId() if context else 0
    table, carriers, round_ = ContentTable(budget), [], 0
    for batch in sliced(batches, "text", budget // 2):
        names, digests, hashes, texts = [], [], [], []
        for text in batch.column("text").to_pylist():
            content = text.encode()
            hashed = xxhash.xxh64_intdigest(content)
            entry = table.find(hashed, content)
            carried = None
            if entry < 0:
                if not table.has_room(content):
                    table.clear()
                    carriers, round_ = [], round_ + 1
                entry = table.add(hashed, content)
                carriers.append((f"{task}.{round_}.{entry}", hashlib.sha256(content).hexdigest()))
                carried = text
            names.append(carriers[entry][0])
            digests.append(carriers[entry][1])
            hashes.append(hashed)
            texts.append(carried)
        signed = np.array(hashes, dtype=np.uint64).view(np.int64)
        yield record_batch(LOCAL, batch.column("doc_id"), names, digests, signed, texts)


def _spill_file(part: int):
    """A file of this task attempt, gone when closed, in a folder where Spark spills its own shuffles."""
    folders = [folder for folder in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if folder]
    return tempfile.TemporaryFile(dir=folders[part % len(folders)] if folders else None)


def grace_classes(
    records: Iterator[tuple[int, str, bytes]], table: ContentTable, level: int = 0, fan: int = FAN
) -> Iterator[tuple[str, str]]:
    """(name, name of the first record with the same content) for records (hash, name, content).

    A record equal to one in the table never reaches a spill file, and each level places at
    least one content, so the recursion ends even if all hashes are equal.
    """
    names: list[str] = []
    files: dict[int, object] = {}
    table.clear()
    for hashed, name, content in records:
        entry = table.find(hashed, content)
        if entry < 0 and table.has_room(content):
            entry = table.add(hashed, content)
            names.append(name)
        if entry >= 0:
            yield name, names[entry]
            continue
        part = xxhash.xxh64_intdigest(hashed.to_bytes(8, "little"), level + 1) % fan
        if part not in files:
            files[part] = _spill_file(part)
        pickle.dump((hashed, name, content), files[part], protocol=5)
    for part in list(files):
        with files.pop(part) as file:
            file.seek(0)
            yield from grace_classes(_spilled(file), table, level + 1, fan)


def _spilled(file) -> Iterator[tuple[int, str, bytes]]:
    while True:
        try:
            yield pickle.load(file)  # noqa: S301  written by this task
        except EOFError:
            return


def _class_batches(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("carrier", pa.string()), ("class", pa.string())])

    def records():
        for batch in sliced(batches, "text", 1 << 24):
            hashes = batch.column("hash").to_numpy().view(np.uint64).tolist()
            names, texts = batch.column("carrier").to_pylist(), batch.column("text").to_pylist()
            for hashed, name, text in zip(hashes, names, texts, strict=True):
                yield hashed, name, text.encode()

    carriers, classes = [], []
    for carrier, first in grace_classes(records(), ContentTable(budget)):
        carriers.append(carrier)
        classes.append(first)
        if len(carriers) == 10_000:
            yield record_batch(schema, carriers, classes)
            carriers, classes = [], []
    yield record_batch(schema, carriers, classes)


def exact_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", budget: int = TABLE_BYTES
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Texts are equal when all their bytes are; of equal texts the row with the largest id
    stays. Defined cases: a null text is an empty one; a row without id has a
    result, and stays only if its whole group has none; of rows that repeat the largest id all count
    as kept; other columns of ``docs`` are not looked at.
    """
    rows = docs.select(docs[id].cast("long").alias("doc_id"), text_of(docs, text).alias("text"))
    local = stored(
        rows.mapInArrow(
            partial(_local_batches, budget=budget),
            "doc_id long, carrier string, text_sha256 string, hash long, text string",
        ),
        "local_groups",
    )
    carried = local.where(F.col("text").isNotNull()).select("hash", "carrier", "text")
    classes = stored(
        carried.repartition("hash").mapInArrow(
            partial(_class_batches, budget=budget), "carrier string, class string"
        ),
        "grace_classes",
    )
    by_carrier = local.groupBy("carrier").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    placed = by_carrier.join(classes, "carrier")
    whole = placed.groupBy("class").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    by_class = classes.join(whole, "class").select("carrier", "keep_id", "group_size")
    return local.select("doc_id", "carrier", "text_sha256").join(by_class, "carrier").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
