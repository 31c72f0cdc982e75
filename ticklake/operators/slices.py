"""Slices that keep ordered windows small when one symbol holds much of the data.

A window partitioned by symbol puts each symbol in one task. Here the symbols above the row limit are
sorted together, by symbol and order, over as many range partitions as they need, and each
partition is a slice; it also receives the few rows before it that its first frames reach back
to. The range partitioner cuts where it must, inside a second or among rows without a time too, so no
slice outgrows its task whatever the times are. The results equal the uncut window in
every session zone: nothing is computed from a time.

The sorted rows are kept in the shared folder. Which slices lend to which follows from the number
of rows of each symbol in each partition: a boundary cuts one symbol at most, so this list is as long as
there are partitions, and is worked out on the driver.

The table is read for the count (one column), and its large symbols for the sort and its sample.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake import scratch

SLICE_ROWS = 4_000_000
MAX_HOT = 100_000


@dataclass(frozen=True)
class Large:
    """The row limit, the symbols above it (at most MAX_HOT), and how many rows they have together."""

    limit: int
    symbols: DataFrame
    rows: int


def large_symbols(ticks: DataFrame, slice_rows: int = SLICE_ROWS) -> Large | None:
    """What is to be cut; None when no symbol is that large.

    Counts rows per symbol (one column, combined map-side), keeps the counts in the shared
    folder and fetches one row. Callers with several windows over one table count once.
    """
    counts = scratch.checkpointed(ticks.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")))
    total, largest = counts.agg(F.sum("rows"), F.max("rows")).first()
    limit = max(slice_rows, (total or 0) // MAX_HOT)
    if (largest or 0) <= limit:
        return None
    hot = counts.filter(F.col("rows") > limit)
    return Large(limit, hot.select("symbol"), hot.agg(F.sum("rows")).first()[0])


def lenders(pieces: Sequence[tuple[str, int, int, int]], reach: int) -> list[tuple[str, int, int, int]]:
    """(symbol, slice, first place lent, borrowing slice) from (symbol, slice, first place, rows) of all pieces.

    A slice borrows the ``reach`` rows of its symbol before it, from as many slices as that takes.
    """
    found = []
    before: dict[str, list[tuple[int, int, int]]] = {}
    for symbol, part, first, rows in sorted(pieces, key=lambda piece: (piece[0], piece[1])):
        earlier = before.setdefault(symbol, [])
        needed = reach
        for lender, lender_first, lender_rows in reversed(earlier):
            if needed <= 0:
                break
            lent = min(needed, lender_rows)
            found.append((symbol, lender, lender_first + lender_rows - lent, part))
            needed -= lent
        earlier.append((part, first, rows))
    return found


def with_reach(ticks: DataFrame, large: Large, reach: int, needed: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows with their ``slice`` and their ``place`` in it (``own`` true) plus, per slice, the ``reach`` rows before it.

    ``slice`` and ``place`` are NULL for symbols of ordinary size; inside a slice rows stand in the order of
    ``place``, which agrees with ``order``. ``needed`` are the columns the frames read, all the
    others are NULL in borrowed rows (``own`` false).
    """
    spark = ticks.sparkSession
    hot = F.broadcast(large.symbols)
    none = F.lit(None).cast("bigint")
    ordinary = ticks.join(hot, "symbol", "left_anti").withColumns({"slice": none, "place": none})
    parts = -(-2 * large.rows // large.limit)
    keys = [F.col("symbol"), *order, F.col("row")]  # the last, so that equal rows can be cut apart too
    sorted_rows = (
        ticks.join(hot, "symbol", "left_semi")
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .drop("row")
        .withColumn("place", F.monotonically_increasing_id())
    )
    cut = scratch.checkpointed(sorted_rows).withColumn("slice", F.shiftright("place", 33))
    pieces = cut.groupBy("symbol", "slice").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    loans = lenders([tuple(row) for row in pieces.collect()], reach)  # a row per partition and symbol cut
    lent = F.broadcast(spark.createDataFrame(loans, "symbol string, slice bigint, since bigint, borrower bigint"))
    borrowed = (
        cut.select("symbol", "slice", "place", *needed)
        .join(lent, ["symbol", "slice"])
        .filter(F.col("place") >= F.col("since"))
        .select("symbol", *needed, F.col("borrower").alias("slice"), "place")
    )
    own = ordinary.unionByName(cut).withColumn("own", F.lit(True))
    return own.unionByName(borrowed.withColumn("own", F.lit(False)), allowMissingColumns=True)
