"""Best-fit packing of documents into sequences of several permitted lengths.

All permitted lengths are in play at once. A piece goes where it leaves the least room; if no
open bin has room, the bin size opens that costs least per token expected in it, and in the end
each bin shrinks to the smallest permitted length that holds its contents.

Documents are dealt by a hash of their id and text into shares, and a share is packed by one task:
the loss against packing all together is the last, half-empty bins of a share. Only rows that repeat
an id and a text can make a share large; it is then cut into further shares as its rows come.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import record_batch, text_of

#: Documents of a share; their ids and lengths are what a task holds. A share of ``CUT`` times as
#: many is cut.
SHARE_ROWS = 50_000
CUT = 4


@dataclass(frozen=True)
class Lengths:
    """Permitted sequence lengths and what a sequence costs.

    A sequence of n tokens costs ``fixed + n + n * n / square``: an overhead for each
    sequence, work that grows with its tokens, and attention, which grows with their square.
    """

    permitted: tuple[int, ...] = (512, 1024, 2048, 4096)
    fixed: float = 16.0
    square: float = 8192.0

    def __post_init__(self) -> None:
        if not self.permitted or min(self.permitted) < 1 or list(self.permitted) != sorted(set(self.permitted)):
            raise ValueError("permitted lengths rise and are at least 1")

    def cost(self, length: int) -> float:
        return self.fixed + length + length * length / self.square

    def opened(self, size: int, waiting: int) -> int:
        """The bin to open for a piece of ``size`` when ``waiting`` tokens, with it, are unplaced.

        Of the lengths that hold the piece, the one of least cost per token it can be filled with.
        """
        fitting = [length for length in self.permitted if length >= size]
        return min(fitting, key=lambda length: (self.cost(length) / min(length, waiting), length))

    def shrunk(self, used: int) -> int:
        return self.permitted[bisect.bisect_left(self.permitted, used)]


def cut(tokens: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, and a rest."""
    return [(start, min(longest, tokens - start)) for start in range(0, tokens, longest)]


def pack(sizes: list[int], lengths: Lengths) -> list[tuple[int, int]]:
    """(bin, offset in it) of each piece; pieces are taken as they come, largest first is best.

    Open bins are kept by the room they have left, so the best fit is found by bisection.
    """
    rooms: list[int] = []  # sorted; bins of equal room in by_room, last in first out
    by_room: dict[int, list[int]] = {}
    used: list[int] = []
    placed = []
    waiting = sum(sizes)
    for size in sizes:
        at = bisect.bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            bins = by_room[room]
            chosen = bins.pop()
            if not bins:
                del by_room[room], rooms[at]
        else:
            room = lengths.opened(size, max(waiting, 1))
            chosen = len(used)
            used.append(0)
        placed.append((chosen, used[chosen]))
        used[chosen] += size
        waiting -= size
        if room > size:
            if room - size not in by_room:
                bisect.insort(rooms, room - size)
                by_room[room - size] = []
            by_room[room - size].append(chosen)
    return placed


def used_lengths(sizes: list[int], placed: list[tuple[int, int]], lengths: Lengths) -> list[int]:
    """The permitted length each bin shrinks to."""
    used = [0] * (max((bin_ for bin_, _ in placed), default=-1) + 1)
    for size, (bin_, _) in zip(sizes, placed, strict=True):
        used[bin_] += size
    return [lengths.shrunk(total) for total in used]


PLACES = "doc_id long, piece long, start long, length long, share int, bin long, offset long, capacity long"
PLACE_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]
    + [("share", pa.int32()), ("bin", pa.int64()), ("offset", pa.int64()), ("capacity", pa.int64())]
)


def packed_share(share: int, rows: list[tuple[int | None, int]], lengths: Lengths) -> Iterator[pa.RecordBatch]:
    """The places of one share's (doc_id, tokens) rows, whatever their order.

    Full pieces of long documents fill bins of their own and are not held: they come out as the
    document is cut.
    """
    longest = lengths.permitted[-1]
    rests, bin_, out = [], 0, []
    for doc, tokens in sorted(rows, key=lambda row: (row[0] is None, row[0] or 0, row[1])):
        for piece, (start, size) in enumerate(cut(tokens, longest)):
            if size < longest:
                rests.append((size, doc, piece, start))
                continue
            out.append((doc, piece, start, size, share, bin_, 0, longest))
            bin_ += 1
            if len(out) == 100_000:
                yield record_batch(PLACE_SCHEMA, *zip(*out, strict=True))
                out = []
    rests.sort(key=lambda row: (-row[0], row[1] is None, row[1] or 0, row[2]))
    sizes = [row[0] for row in rests]
    placed = pack(sizes, lengths)
    capacities = used_lengths(sizes, placed, lengths)
    out += [
        (doc, piece, start, size, share, bin_ + number, offset, capacities[number])
        for (size, doc, piece, start), (number, offset) in zip(rests, placed, strict=True)
    ]
    if out:
        yield record_batch(PLACE_SCHEMA, *zip(*out, strict=True))


def _share_batches(
    batches: Iterator[pa.RecordBatch], lengths: Lengths, shares: int, most: int
) -> Iterator[pa.RecordBatch]:
    """Shares one after the other; rows come sorted by share, id and tokens.

    What is cut off a share of over ``most`` rows takes the next number of equal remainder.
    """
    current, number, rows = None, 0, []
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("share", "doc_id", "tokens"))
        for share, doc, tokens in zip(*columns, strict=True):
            if share != current:
                if rows:
                    yield from packed_share(number, rows, lengths)
                current, number, rows = share, share, []
            elif len(rows) == most:
                yield from packed_share(number, rows, lengths)
                number, rows = number + shares, []
            rows.append((doc, tokens))
    if rows:
        yield from packed_share(number, rows, lengths)


def word_count(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def packing(
    docs: DataFrame,
    lengths: Lengths = Lengths(),  # noqa: B008  immutable
    tokens: Column | None = None,
    id: str = "doc_id",
    text: str = "text",
    share_rows: int = SHARE_ROWS,
) -> DataFrame:
    """(doc_id, piece, start, length, share, bin, offset, capacity): where each piece of each document goes.

    ``tokens`` is the length of a row; the default counts its words. A document longer than the
    longest permitted length is cut into full pieces and a rest. (share, bin) names a sequence.
    Defined cases: a document without tokens has no piece; rows without an id, and rows that
    repeat one, are placed like others; other columns of ``docs`` are not looked at.
    """
    shares = max(1, -(-docs.count() // share_rows))
    whole = text_of(docs, text)
    rows = docs.select(
        docs[id].cast("long").alias("doc_id"),
        (word_count(whole) if tokens is None else tokens).cast("long").alias("tokens"),
        F.pmod(F.xxhash64(docs[id].cast("long"), whole), F.lit(shares)).cast("int").alias("share"),
    ).where("tokens > 0")
    return (
        rows.repartition(shares, "share")
        .sortWithinPartitions("share", "doc_id", "tokens")
        .mapInArrow(
            partial(_share_batches, lengths=lengths, shares=shares, most=CUT * share_rows), PLACES
        )
    )
