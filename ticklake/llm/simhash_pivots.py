"""Near-duplicate documents by SimHash, found through tables of pivot distances.

A fingerprint's bit is 1 where over half of its shingle hashes have it set. The Hamming
distances from every fingerprint to fixed reference fingerprints are computed once. By
the triangle inequality two fingerprints within ``radius`` of each other differ by at
most ``radius`` in each of these coordinates, so a pair with a larger difference in any
coordinate is discarded unseen; what survives is verified bit by bit.

Distances to whole random references crowd around half the length, so alone they leave a
large share of all pairs, and the pairs are not made from them. Blocks are: the bits are cut into
``radius + 1`` bands, two fingerprints within the radius agree in all bits of at least one band, and
rows with equal bits in a band make a block. (In terms of pivots: the distances to references that
differ in one bit of the band only tell the band's bits.) Inside a block rows are sorted by their
distance to the first reference, so that partners lie in a sliding window of width
``radius``, and the other coordinates discard most of the window.

Blocks above ``limit`` rows are split: very large ones by bands of the remaining bits,
others into pairs of sub-blocks. No pair within the radius is lost by either.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import record_batch, sliced, stored, text_of
from ticklake.llm.components import components

#: Shingles hashed at a time, so that the hashes of a very long text need no more memory than this.
CHUNK = 1 << 16

#: Reference fingerprints besides those of the bands.
REFERENCES = 8

#: Rows compared at a time in one task.
WINDOW = 1 << 16

#: Sub-blocks that a block is split into at most before further bands are used.
PARTS = 64


@dataclass(frozen=True)
class Scheme:
    """How fingerprints of 64 bits are made and which of them are links."""

    words: int = 4
    radius: int = 4
    seed: int = 42
    limit: int = 2048

    def bands(self) -> list[tuple[int, int]]:
        """(first bit, width) of each of ``radius + 1`` bands: two links agree in one of them."""
        cuts = [round(64 * i / (self.radius + 1)) for i in range(self.radius + 2)]
        return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


#: The contract of the registered query.
DOCUMENTS = Scheme()


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 255 * 64):
        part = hashes[start : start + 255 * 64]
        lanes = np.unpackbits(part.view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
        for row in range(0, len(lanes), 255):  # 255 ones still fit a byte
            counts += lanes[row : row + 255].sum(axis=0).view(np.uint8)
    return counts


def shingle_hashes(text: str, scheme: Scheme) -> Iterator[np.ndarray]:
    """Hashes of the text's shingles in order, repeats included, a chunk at a time."""
    words = text.encode().lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(scheme.words, len(words))
    firsts, lasts = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest, seed = xxhash.xxh64_intdigest, scheme.seed
    for at in range(0, len(firsts), CHUNK):
        spans = zip(firsts[at : at + CHUNK], lasts[at : at + CHUNK], strict=True)
        yield np.array([digest(joined[a:b], seed) for a, b in spans], dtype=np.uint64)


def fingerprint(text: str, scheme: Scheme = DOCUMENTS) -> int:
    """The fingerprint as an unsigned number; zero for a text without words."""
    counts, shingles = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text, scheme):
        shingles += len(hashes)
        counts += _set_bits(hashes)
    return int(np.packbits(counts * 2 > shingles, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], scheme: Scheme) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    for batch in sliced(batches, "text", 1 << 24):
        prints = [fingerprint(text, scheme) for text in batch.column("text").to_pylist()]
        yield record_batch(schema, batch.column("doc_id"), np.array(prints, dtype=np.uint64).view(np.int64))


def fingerprints(
    docs: DataFrame, scheme: Scheme = DOCUMENTS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp) of every row, ``fp`` as a signed number; a null text is empty."""
    rows = docs.select(docs[id].cast("long").alias("doc_id"), text_of(docs, text).alias("text"))
    return rows.mapInArrow(partial(_fingerprint_batches, scheme=scheme), "doc_id long, fp long")


def _references(scheme: Scheme) -> np.ndarray:
    made = [xxhash.xxh64_intdigest(f"reference {i} 0", scheme.seed) for i in range(REFERENCES)]
    return np.array(made, dtype=np.uint64)


def _connect(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Adds links to the labels; a label is the least row of its component so far."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(above := label[label], label):
            label[:] = above


def _near_pairs(
    keys: np.ndarray, prints: np.ndarray, table: np.ndarray, radius: int, label: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(left, right) of pairs of equal keys within the radius whose labels differ.

    Rows are sorted by key and first coordinate. Labels are read anew at every step, so
    pairs that the caller has joined meanwhile are not looked at again.
    """
    rows = np.arange(len(keys))
    for step in range(1, len(keys)):
        rows = rows[rows < len(keys) - step]
        # keys are sorted, and distances inside a key: who is out of reach here stays so
        rows = rows[
            (keys[rows] == keys[rows + step]) & (table[0][rows + step] - table[0][rows] <= radius)
        ]
        if not len(rows):
            return
        left = rows[label[rows] != label[rows + step]]
        for coordinate in table[1:]:
            left = left[np.abs(coordinate[left] - coordinate[left + step]) <= radius]
        left = left[np.bitwise_count(prints[left] ^ prints[left + step]) <= radius]
        if len(left):
            yield left, left + step


def _pivot_order(keys: np.ndarray, prints: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows by key and first coordinate, their coordinates in this order)."""
    table = np.bitwise_count(prints[:, None] ^ references[None]).astype(np.int16)
    order = np.lexsort((table[:, 0], keys))
    return order, np.ascontiguousarray(table[order].T)


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a sorted partition in pieces that cut no block apart."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < WINDOW:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
        rows = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _link_batches(batches: Iterator[pa.RecordBatch], scheme: Scheme) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    references = _references(scheme)
    for table in _whole_blocks(batches):
        keys, nodes = table.column("key").to_numpy(), table.column("fp").to_numpy()
        _, run, size = np.unique(keys, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(size[run] > 1)
        if not len(shared):
            continue
        prints = nodes.view(np.uint64)
        order, distances = _pivot_order(keys[shared], prints[shared], references)
        order = shared[order]
        keys, nodes, prints = keys[order], nodes[order], prints[order]
        label = np.arange(len(keys))
        for left, right in _near_pairs(keys, prints, distances, scheme.radius, label):
            _connect(label, left, right)
        moved = np.flatnonzero(label != np.arange(len(label)))
        yield record_batch(schema, nodes[moved], nodes[label[moved]])


def _band_rows(prints: DataFrame, scheme: Scheme) -> DataFrame:
    """Each fingerprint once per band, keyed by the band and its bits."""
    cells = [
        F.struct(
            F.lit(number).alias("band"),
            F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1).alias("content"),
        )
        for number, (first, width) in enumerate(scheme.bands())
    ]
    return prints.select("fp", F.explode(F.array(*cells)).alias("cell")).select(
        "fp", "cell.band", F.xxhash64("cell.band", "cell.content").alias("key")
    )


def _finer_rows(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """Rows of very large blocks keyed anew by ``radius + 1`` bands of the bits outside their own band."""
    finer = None
    for number, (first, width) in enumerate(scheme.bands()):
        left = [bit for bit in range(64) if not first <= bit < first + width]
        contents = []
        for part in np.array_split(np.array(left), scheme.radius + 1):
            mask = sum(1 << int(bit) for bit in part)
            kept = F.col("fp").bitwiseAND(mask - (1 << 64) if mask >> 63 else mask)
            contents.append(F.xxhash64(F.lit(len(contents)), kept))
        cut = (
            rows.where(F.col("band") == number)
            .withColumn("content", F.explode(F.array(*contents)))
            .select("fp", "band", F.xxhash64("key", "content").alias("key"))
        )
        finer = cut if finer is None else finer.union(cut)
    return finer


def _split_large(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """The rows with large blocks split, so that no block has many more than ``limit`` rows."""
    sizes = rows.groupBy("key").count().where(F.col("count") > scheme.limit)
    if sizes.isEmpty():
        return rows
    marked = rows.join(sizes, "key", "left")
    huge = marked.where(F.col("count") > scheme.limit * PARTS)
    if not huge.isEmpty():
        finer = _finer_rows(huge.drop("count"), scheme)
        again = finer.groupBy("key").count().where(F.col("count") > scheme.limit)
        marked = (
            marked.where(F.coalesce("count", F.lit(0)) <= scheme.limit * PARTS)
            .select("fp", "band", "key", "count")
            .union(finer.join(again, "key", "left").select("fp", "band", "key", "count"))
        )
    parts = F.ceil(F.coalesce("count", F.lit(1)) / scheme.limit).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    return (
        marked.withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "fp",
            "band",
            F.when(F.col("parts") == 1, F.col("key"))
            .otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
            .alias("key"),
        )
    )


def links(prints: DataFrame, scheme: Scheme = DOCUMENTS) -> DataFrame:
    """(a, b) pairs that join all fingerprints within the radius into the same components.

    ``prints`` has (fp), each fingerprint once. Inside a block a link between two
    already joined rows is left out, so there are at most as many pairs as rows.
    """
    rows = _split_large(_band_rows(prints, scheme), scheme)
    tasks = rows.select("fp", "key").repartition("key").sortWithinPartitions("key")
    return tasks.mapInArrow(partial(_link_batches, scheme=scheme), "a long, b long")


def groups(
    docs: DataFrame, scheme: Scheme = DOCUMENTS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id) of every row.

    ``component_id`` is the smallest doc_id reachable over fingerprints at most
    ``radius`` bits apart. Defined cases: a null or wordless text has fingerprint zero and
    is linked like any other; rows that repeat an id, or a text, keep their own result row; a
    row without id links like any other, and its component is null where no row of
    the group has an id; other columns of ``docs`` are not looked at.
    """
    made = stored(fingerprints(docs, scheme, id, text), "fingerprints")
    prints = stored(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    joined = components(links(prints.select("fp"), scheme)).withColumnRenamed("node", "fp")
    placed = prints.join(joined, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = placed.join(ids, "component").select("fp", "component_id")
    return made.join(by_print, "fp").select("doc_id", "fp", "component_id")


def kept_documents(
    docs: DataFrame, scheme: Scheme = DOCUMENTS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group one row, with the smallest id.

    Rows are told apart by a number of their own, so of rows that repeat the smallest id one stays
    (by a hash of the text, then the number), and rows that share an id but no group are
    decided each by its own group. Rows without an id stay. Null and wordless texts are near copies of each
    other. Columns of ``docs`` may have any names; all are returned as they are.
    """
    row = "row"
    while row in docs.columns:
        row += "_"
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    named = numbered.where(numbered[id].cast("long").isNotNull())
    found = stored(groups(named, scheme, row, text).select(F.col("doc_id").alias("row"), "component_id"), "groups")
    order = named.select(
        F.col(row).alias("row"),
        F.struct(named[id].cast("long").alias("id"), F.xxhash64(text_of(named, text)).alias("hash"), F.col(row).alias("row")).alias("place"),
    )
    shared = found.groupBy("component_id").count().where("count > 1").drop("count")
    rivals = stored(found.join(shared, "component_id").join(order, "row"), "rivals")
    heads = rivals.groupBy("component_id").agg(F.min("place").alias("head"))
    dropped = rivals.join(heads, "component_id").where("place.row <> head.row").select(F.col("row").alias(row))
    return numbered.join(dropped, row, "left_anti").select(*(numbered[c] for c in docs.columns))
