"""Line de-duplication across documents by deletion neighbourhoods.

A line is a sequence of words. The first occurrence of a line, by document id and line number,
stays if no earlier line lies within one word inserted, removed or replaced; other occurrences go.
Two lines within one edit share a variant: a line without the word at one position. Replaced
words leave the same variant at the same position, an inserted word leaves the other line whole.
Rows with equal keys of (variant, position) are all within one edit of one another, so a join
with the earliest of each key finds every line that has an earlier neighbour, without pairs.

Variants are as many as words, so only lines that can have a neighbour get them: one edit leaves
the first or the last half of a line as it is, so a line whose halves occur in no other line has no
neighbour. Candidates are verified on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import discard, record_batch, sliced, stored, text_of

#: Words a line needs to be compared with others than its equals: one edit is then an eighth at most.
NEAR_WORDS = 8

#: Text split into lines at a time, and words whose hashes are remembered where variants are made.
PIECE = 4 << 20
REMEMBERED = 300_000

#: Shuffled pieces per shuffle partition; one is sorted in memory at a time.
PIECES = 4

#: Odd multipliers of the two rolling hashes.
FACTOR = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1

#: Bits that tell the kinds of keys apart.
WHOLE, FIRST_HALF, LAST_HALF = 0, 1, 2


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _stirred(hashes: np.ndarray, lengths: np.ndarray, kind: int) -> np.ndarray:
    x = hashes ^ (lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(kind))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of any word range of a batch of lines, from prefix sums modulo 2^64."""

    def __init__(self, words: np.ndarray, factor: int = FACTOR) -> None:
        n = len(words) + 1
        self.inverse = np.uint64(pow(factor, -1, 1 << 64))
        steps = np.full(n, factor, dtype=np.uint64)
        steps[0] = 1
        powers = np.multiply.accumulate(steps)
        steps[1:] = self.inverse
        self.back = np.multiply.accumulate(steps)
        self.sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(words * powers[:-1])))

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def without(self, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The range without the word at one index of it."""
        left = self.sums[at] - self.sums[start]
        right = (self.sums[end] - self.sums[at + 1]) * self.inverse
        return (left + right) * self.back[start]


def _sums_by_place(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each line that is no polynomial: sums of words stirred with their place in the line.

    There are lines on which polynomials modulo 2^64 agree whatever their odd factor.
    """
    place = np.arange(len(words), dtype=np.uint64) - np.repeat(start, end - start).astype(np.uint64)
    x = words + place * np.uint64(FACTOR)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(x ^ (x >> np.uint64(31)))))
    return sums[end] - sums[start]


def split_lines(text: str) -> Iterator[tuple[int, list[bytes]]]:
    """(line number, words) of the lines that have words."""
    for number, line in enumerate(text.split("\n")):
        if words := line.encode().split():
            yield number, words


ENTRY = np.dtype(
    [("key", "u8"), ("check", "u8"), ("doc", "i8"), ("line", "i4"), ("kind", "i1")]
)  # check: of whole lines a second hash, of halves the hash of the whole line


def _packed(entries: np.ndarray) -> bytes:
    columns = [np.ascontiguousarray(entries[name]).tobytes() for name in ENTRY.names]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(columns))


def _unpacked(blob: bytes, rows: int) -> np.ndarray:
    content = zstandard.ZstdDecompressor().decompress(blob)
    entries, at = np.empty(rows, dtype=ENTRY), 0
    for name in ENTRY.names:
        size = rows * ENTRY[name].itemsize
        entries[name] = np.frombuffer(content, dtype=ENTRY[name], count=rows, offset=at)
        at += size
    return entries


def _hashed_lines(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``split_lines`` of many texts: hashes of all words, and of each line its text, its number and where its words end."""
    lines = pc.split_pattern(texts, "\n")
    sizes = lines.value_lengths().to_numpy(zero_copy_only=False)
    split = pc.ascii_split_whitespace(lines.flatten())
    words = split.flatten()
    stays = pc.greater(pc.binary_length(words), 0)  # white space at an end splits off an empty word
    found = words.filter(stays).cast(pa.binary()).dictionary_encode()
    distinct = found.dictionary.to_numpy(zero_copy_only=False)  # bytes, made much faster than by to_pylist
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), dtype=np.uint64, count=len(distinct))
    counts = np.concatenate(([0], np.cumsum(stays.to_numpy(zero_copy_only=False), dtype=np.int64)))
    ends = counts[np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)]
    worded = np.diff(ends, prepend=0) > 0
    text = np.repeat(np.arange(len(sizes)), sizes)
    number = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return hashes[found.indices.to_numpy()], text[worded], number[worded], ends[worded]


def _entries(texts: pa.StringArray, docs: np.ndarray) -> np.ndarray:
    """Whole-line and half-line entries of a few documents."""
    words, of_text, of_line, end = _hashed_lines(texts)
    start = np.concatenate((np.zeros(1, dtype=np.int64), end))[:-1]
    length = end - start
    rolling = Rolling(words)
    whole = _stirred(rolling.span(start, end), length, WHOLE)
    second = _stirred(_sums_by_place(words, start, end), length, WHOLE)
    doc, line = docs[of_text], of_line.astype(np.int32)

    def made(rows, key, check, kind):
        out = np.empty(len(rows), dtype=ENTRY)
        out["key"], out["check"], out["doc"], out["line"], out["kind"] = key, check, doc[rows], line[rows], kind
        return out

    parts = [made(np.arange(len(doc)), whole, second, WHOLE)]
    for longer in (0, 1):  # the longer line of a pair has n or n + 1 words, and counts the halves
        rows = np.flatnonzero(length + longer >= NEAR_WORDS)
        a, b, n = start[rows], end[rows], length[rows] + longer
        half = n // 2
        parts.append(made(rows, _stirred(rolling.span(a, a + half), n, FIRST_HALF), whole[rows], FIRST_HALF))
        parts.append(made(rows, _stirred(rolling.span(b - half, b), n, LAST_HALF), whole[rows], LAST_HALF))
    return np.concatenate(parts)


def _found(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(later equal lines, their first, lines of shared halves, entries still to be compared).

    Of entries of one key and check the earliest stands for all, here and for other tasks.
    """
    entries = entries[np.lexsort((entries["line"], entries["doc"], entries["check"], entries["key"]))]
    new_key = np.concatenate(([True], entries["key"][1:] != entries["key"][:-1]))
    new = new_key | np.concatenate(([True], entries["check"][1:] != entries["check"][:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(entries)), 0))
    whole = entries["kind"] == WHOLE
    later = ~new & whole
    kept = np.flatnonzero(new)
    group = np.cumsum(new_key)[kept] - 1
    size = np.bincount(group)
    shared = kept[(size[group] > 1) & ~whole[kept]]
    # of a half two different lines go on, so that entries of other tasks learn that it is shared
    rank = np.arange(len(kept)) - np.concatenate(([0], np.cumsum(size)[:-1]))[group]
    going = kept[whole[kept] | (rank < 2)]
    return entries[later], entries[first[later]], entries[shared], entries[going]


MARKS = "near boolean, doc_id long, line int, whole long, by_doc long, by_line int"
MARK_SCHEMA = pa.schema(
    [("near", pa.bool_()), ("doc_id", pa.int64()), ("line", pa.int32()), ("whole", pa.int64())]
    + [("by_doc", pa.int64()), ("by_line", pa.int32())]
)


def _mark_batch(near: bool, entries: np.ndarray, by: np.ndarray | None = None) -> pa.RecordBatch:
    n = len(entries)
    return record_batch(
        MARK_SCHEMA,
        pa.array(np.full(n, near)),
        entries["doc"],
        entries["line"],
        (entries["check"] if near else entries["key"]).view(np.int64),
        pa.nulls(n, pa.int64()) if by is None else by["doc"],
        pa.nulls(n, pa.int32()) if by is None else by["line"],
    )


PIECE_ROWS = "piece int, rows int, blob binary"


def _piece_batches(batches: Iterator[pa.RecordBatch], pieces: int) -> Iterator[pa.RecordBatch]:
    """Packed entries by piece of the key space; what this task can tell itself goes as piece -1."""
    schema = pa.schema([("piece", pa.int32()), ("rows", pa.int32()), ("blob", pa.binary())])
    held: list[np.ndarray] = []

    def flush():
        later, first, shared, going = _found(np.concatenate(held))
        held.clear()
        numbers, rows, blobs = [], [], []
        # equal lines of one task: the later are gone whatever other tasks hold
        for kind, entries in ((-1, np.concatenate((later, first))), (-2, shared)):
            if len(entries):
                numbers.append(kind)
                rows.append(len(entries))
                blobs.append(_packed(entries))
        piece = (going["key"] >> np.uint64(20)) % np.uint64(pieces)
        order = np.argsort(piece, kind="stable")
        going, piece = going[order], piece[order]
        cuts = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1], [True])))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            numbers.append(int(piece[a]))
            rows.append(b - a)
            blobs.append(_packed(going[a:b]))
        return record_batch(schema, numbers, rows, blobs)

    for batch in sliced(batches, "text", PIECE):
        held.append(_entries(batch.column("text"), batch.column("doc_id").to_numpy()))
        if sum(map(len, held)) >= 1_000_000:
            yield flush()
    if sum(map(len, held)):
        yield flush()


def _mark_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks from the pieces of a partition, sorted by piece."""
    held: list[np.ndarray] = []
    current = None

    def flush():
        if held:
            later, first, shared, _ = _found(np.concatenate(held))
            held.clear()
            yield _mark_batch(False, later, first)
            yield _mark_batch(True, shared)

    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("piece", "rows", "blob"))
        for piece, rows, blob in zip(*columns, strict=True):
            if piece != current:
                yield from flush()
                current = piece
            held.append(_unpacked(blob, rows))
    yield from flush()


def _local_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks that the scanning tasks found themselves."""
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("piece", "rows", "blob"))
        for kind, rows, blob in zip(*columns, strict=True):
            entries = _unpacked(blob, rows)
            if kind == -1:
                yield _mark_batch(False, *np.split(entries, 2))
            else:
                yield _mark_batch(True, entries)


LINES = "doc_id long, line int, whole long, words array<binary>"


def _near_line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted lines of each document."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("line", pa.int32()), ("whole", pa.int64()), ("words", pa.list_(pa.binary()))]
    )
    for batch in sliced(batches, "text", 1 << 24):
        rows = []
        columns = (batch.column(name).to_pylist() for name in ("doc_id", "text", "wanted"))
        for doc, text, wanted in zip(*columns, strict=True):
            marked = {(mark["line"], mark["whole"]) for mark in wanted}
            numbers = {line for line, _ in marked}
            for number, words in split_lines(text):
                if number in numbers and (number, line_hash(words)) in marked:
                    rows.append((doc, number, line_hash(words), words))
        yield record_batch(schema, *([row[i] for row in rows] for i in range(4)))


def line_hash(words: list[bytes]) -> int:
    """The signed hash of a whole line."""
    hashes = np.array([xxhash.xxh64_intdigest(word) for word in words], dtype=np.uint64)
    n = np.array([len(words)])
    zero = np.zeros(1, dtype=np.int64)
    return int(_stirred(Rolling(hashes).span(zero, n), n, WHOLE).view(np.int64)[0])


def _variant_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per line with position -1, and per word of a line that is long enough."""
    schema = pa.schema([("key", pa.int64()), ("position", pa.int32()), ("doc_id", pa.int64()), ("line", pa.int32())])
    known = _WordHashes()
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            lines = part.column("words").to_pylist()
            length = np.array([len(words) for words in lines], dtype=np.int64)
            hashes = np.array([known[word] for words in lines for word in words], dtype=np.uint64)
            rolling = Rolling(hashes)
            end = np.cumsum(length)
            begin = end - length
            row = np.repeat(np.arange(len(lines)), np.where(length >= NEAR_WORDS, length, 0))
            at = np.arange(len(hashes))[np.repeat(length >= NEAR_WORDS, length)]
            without = _stirred(rolling.without(begin[row], end[row], at), length[row] - 1, WHOLE)
            whole = _stirred(rolling.span(begin, end), length, WHOLE)
            rows = np.concatenate((np.arange(len(lines)), row))
            yield record_batch(
                schema,
                np.concatenate((whole, without)).view(np.int64),
                np.concatenate((np.full(len(lines), -1), at - begin[row])).astype(np.int32),
                part.column("doc_id").to_numpy()[rows],
                part.column("line").to_numpy()[rows],
            )


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one word inserted, removed or replaced, or none, turns one line into the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = 0
    while same < len(a) and a[same] == b[same]:
        same += 1
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def _verified_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("words", "by_words"))
        good = [within_one_edit(a, b) for a, b in zip(*columns, strict=True)]
        yield batch.filter(pa.array(good, pa.bool_())).drop_columns(["words", "by_words"])


def dropped_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line_no, whole, first_doc_id, first_line_no, edits) of every line that goes.

    ``edits`` is 0 for a later copy of an equal line, else 1; "first" is the earliest line equal to
    it, or the earliest within one edit. Lines are counted from 0 and split at line feeds; words
    at ASCII white space; lines without words stay. Lines of fewer than
    ``NEAR_WORDS`` words, in the longer of the two, are compared for equality only.
    Defined cases: a null text has no lines; rows without an id take no part; rows that repeat
    an id and a text count once; other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id].cast("long").alias("doc_id"), text_of(docs, text).alias("text")).where(
        "doc_id is not null"
    )
    pieces = PIECES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = stored(rows.mapInArrow(partial(_piece_batches, pieces=pieces), PIECE_ROWS), "line_pieces")
    met = (
        packed.where("piece >= 0")
        .repartition("piece")
        .sortWithinPartitions("piece")
        .mapInArrow(_mark_batches, MARKS)
        .union(packed.where("piece < 0").mapInArrow(_local_batches, MARKS))
    )
    marks = stored(met.distinct(), "line_marks")
    discard(packed)
    copies = (
        marks.where("not near")
        .where("doc_id != by_doc or line != by_line")
        .groupBy("doc_id", "line", "whole")
        .agg(F.min(F.struct("by_doc", "by_line")).alias("by"))
    )
    # a task's first is itself a copy of another task's: one step leads to the first of all
    roots = copies.select("whole", F.struct(F.col("doc_id").alias("by_doc"), F.col("line").alias("by_line")).alias("by"), F.col("by").alias("root"))
    copies = stored(
        copies.join(roots, ["whole", "by"], "left").select(
            "doc_id", "line", "whole", F.coalesce("root", "by").alias("by")
        ),
        "line_copies",
    )
    place = ["doc_id", "line", "whole"]
    wanted = (
        marks.where("near")
        .select(place)
        .distinct()
        .join(copies.select(place), place, "left_anti")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("line", "whole")).alias("wanted"))
    )
    lines = stored(
        rows.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(_near_line_batches, LINES),
        "near_lines",
    )
    entries = stored(
        lines.mapInArrow(_variant_batches, "key long, position int, doc_id long, line int"), "variants"
    )
    firsts = entries.groupBy("key", "position").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    by_key = firsts.groupBy("key").agg(
        F.min(F.when(F.col("position") < 0, F.col("first"))).alias("whole_first"),
        F.min(F.when(F.col("position") >= 0, F.col("first"))).alias("variant_first"),
    )
    own = F.struct("doc_id", "line")
    candidates = (
        entries.join(firsts, ["key", "position"])
        .join(by_key, "key")
        .select(
            "doc_id",
            "line",
            F.explode(
                F.array(
                    "first",
                    F.when(F.col("position") >= 0, F.col("whole_first")).otherwise(F.col("variant_first")),
                )
            ).alias("by"),
        )
        .where(F.col("by") < own)
        .select("doc_id", "line", F.col("by.doc_id").alias("by_doc"), F.col("by.line").alias("by_line"))
        .distinct()
    )
    texts = lines.groupBy("doc_id", "line").agg(F.first("whole").alias("whole"), F.first("words").alias("words"))
    earlier = texts.select(
        F.col("doc_id").alias("by_doc"), F.col("line").alias("by_line"), F.col("words").alias("by_words")
    )
    near = (
        candidates.join(texts, ["doc_id", "line"])
        .join(earlier, ["by_doc", "by_line"])
        .select("doc_id", "line", "whole", "by_doc", "by_line", "words", "by_words")
        .mapInArrow(_verified_batches, "doc_id long, line int, whole long, by_doc long, by_line int")
        .groupBy("doc_id", "line", "whole")
        .agg(F.min(F.struct("by_doc", "by_line")).alias("by"))
    )
    return (
        copies.withColumn("edits", F.lit(0))
        .union(near.withColumn("edits", F.lit(1)))
        .select(
            "doc_id",
            F.col("line").alias("line_no"),
            "whole",
            F.col("by.by_doc").alias("first_doc_id"),
            F.col("by.by_line").alias("first_line_no"),
            "edits",
        )
    )


def _without_lines(text: str | None, gone: list[dict] | None) -> str | None:
    if not gone or text is None:
        return text
    marked = {(mark["line_no"], mark["whole"]) for mark in gone}
    numbers = {number for number, _ in marked}
    lines = text.split("\n")
    stay = [
        not (number in numbers and (words := line.encode().split()) and (number, line_hash(words)) in marked)
        for number, line in enumerate(lines)
    ]
    return "\n".join(line for line, kept in zip(lines, stay, strict=True) if kept)


def _cleaned_batches(batches: Iterator[pa.RecordBatch], text: str, mark: str, length: str | None) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, text, 1 << 24):
        marks = batch.column(mark).to_pylist()
        before = batch.column(text).to_pylist()
        after = [_without_lines(t, gone) for t, gone in zip(before, marks, strict=True)]
        # a document that loses all it said goes with its lines
        stays = [not gone or bool(t.strip()) for t, gone in zip(after, marks, strict=True)]
        out = batch.drop_columns([mark])
        at = out.schema.get_field_index(text)
        out = out.set_column(at, out.schema.field(at), pa.array(after, out.schema.field(at).type))
        if length is not None:
            at = out.schema.get_field_index(length)
            sizes = [
                old if not gone or t is None else len(t)
                for t, gone, old in zip(after, marks, batch.column(length).to_pylist(), strict=True)
            ]
            out = out.set_column(at, out.schema.field(at), pa.array(sizes, out.schema.field(at).type))
        yield out.filter(pa.array(stays, pa.bool_()))


def without_repeated_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: str | None = "n_chars"
) -> DataFrame:
    """``docs`` with all columns, repeated lines taken out of the texts and ``length`` set anew.

    A document left without words by this goes; one that had none before stays. Columns of ``docs``
    may have any names.
    """
    mark = "gone_lines"
    while mark in [column.lower() for column in docs.columns]:
        mark += "_"
    length = length if length in docs.columns else None
    gone = (
        dropped_lines(docs, id, text)
        .groupBy(F.col("doc_id").alias(id))
        .agg(F.collect_list(F.struct("line_no", "whole")).alias(mark))
    )
    return (
        docs.join(gone, id, "left")
        .select(*docs.columns, mark)
        .mapInArrow(partial(_cleaned_batches, text=text, mark=mark, length=length), docs.schema)
    )
