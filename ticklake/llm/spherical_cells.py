"""Near-duplicate vectors: spherical k-means cells, and blocked cosine products inside them.

Equal vectors are collapsed first, with their number. A bounded sample fits the cell centres; every
vector goes to its nearest centre's cell, its home, and is a guest in the cells whose border
it lies close to. Two vectors across a border are compared in either home where the other is a
guest, and counted once. The border margin is half the distance at the threshold, which loses
no pair. ``exact=False`` takes three standard deviations of the share of a pair's distance that falls
on one direction, over both sides; where vectors fill few dimensions this loses pairs.

Cells of many rows are split into blocks of home rows, each compared with the cell's rows as they
stream by; a block never holds more than ``BLOCK`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import record_batch, stored
from ticklake.llm.components import components

#: Vectors the centres are fitted on at most: those with the smallest hashes.
FIT_ROWS = 20_000

#: Centres at most, which bounds what is sent to every task; vectors per cell aimed at.
CENTRES = 4_096
CELL_ROWS = 1_000

#: Home rows of a block, and rows compared with it at a time.
BLOCK = 2_048
TILE = 1_024


def normalised(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision."""
    rows = np.asarray(vectors, dtype=np.float64)
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), 1e-300)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def spherical_kmeans(vectors: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Centres of length one; a centre that lost all its vectors moves to a random one."""
    random = np.random.default_rng(seed)
    rows = normalised(vectors)
    centres = rows[random.choice(len(rows), size=min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(part @ centres.T).argmax(axis=1) for part in np.array_split(rows, 1 + len(rows) // 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        lengths = np.sqrt((sums * sums).sum(axis=1))
        empty = lengths < 1e-9
        sums[empty] = rows[random.integers(len(rows), size=int(empty.sum()))]
        centres = sums / np.where(empty, 1.0, lengths)[:, None]
    return centres


def _vectors(column: pa.Array) -> np.ndarray:
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


PLACED = pa.schema(
    [("cell", pa.int32()), ("home", pa.int32()), ("node", pa.int64()), ("copies", pa.int64())]
    + [("guest_of", pa.list_(pa.int32())), ("vector", pa.list_(pa.float64()))]
)


def _place_batches(batches: Iterator[pa.RecordBatch], centres: np.ndarray, margin: float) -> Iterator[pa.RecordBatch]:
    """Each vector in its home cell and in those it is a guest of."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = normalised(_vectors(batch.column("vector")))
        nodes, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
        for start in range(0, len(rows), 1024):
            part = rows[start : start + 1024]
            products = part @ centres.T
            home = products.argmax(axis=1)
            apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres[home].T).T, 1e-12))
            lead = products[np.arange(len(part)), home][:, None] - products
            at, cell = np.nonzero(lead <= margin * apart)
            guests = np.split(cell, np.searchsorted(at, np.arange(1, len(part))))
            guests = [g[g != h].tolist() for g, h in zip(guests, home, strict=True)]
            yield record_batch(
                PLACED,
                cell.astype(np.int32),
                home[at].astype(np.int32),
                nodes[start + at],
                copies[start + at],
                [guests[i] for i in at],
                pa.ListArray.from_arrays(
                    np.arange(0, part.shape[1] * len(at) + 1, part.shape[1], dtype=np.int32), part[at].ravel()
                ),
            )


class _Block:
    """The home rows of one block, and what is found about them."""

    def __init__(self, key: tuple[int, int], threshold: float, centres: int) -> None:
        self.key, self.threshold, self.centres = key, threshold, centres
        self.parts: list[tuple] = []
        self.closed = False

    def add_home(self, nodes, copies, vectors, guest_of) -> None:
        guest = np.zeros((len(nodes), self.centres), dtype=bool)
        sizes = [len(cells) for cells in guest_of]
        guest[np.repeat(np.arange(len(nodes)), sizes), [c for cells in guest_of for c in cells]] = True
        self.parts.append((nodes, copies, vectors, guest))

    def close_home(self) -> None:
        self.closed = True
        columns = zip(*self.parts, strict=True)
        self.nodes, self.copies, self.vectors, self.guest = (np.concatenate(c) for c in columns)
        self.label = np.arange(len(self.nodes))
        self.links = np.zeros(len(self.nodes), dtype=np.int64)

    def compare(self, nodes, copies, homes, vectors) -> Iterator[tuple]:
        """Links with other rows of the cell; yields (node, links, partner)."""
        cell = self.key[0]
        for start in range(0, len(nodes), TILE):
            part = slice(start, start + TILE)
            left, right = np.nonzero(self.vectors @ vectors[part].T >= self.threshold)
            right += start
            other = self.nodes[left] != nodes[right]
            left, right = left[other], right[other]
            guests = homes[right] != cell
            # a pair of different homes is counted in the smaller cell, or where alone it is met
            first = ~guests | (cell < homes[right]) | ~self.guest[left, homes[right]]
            left, right, guests = left[first], right[first], guests[first]
            np.add.at(self.links, left, copies[right])
            if guests.any():
                outer, at = np.unique(right[guests], return_inverse=True)
                sums = np.bincount(at, self.copies[left[guests]], len(outer)).astype(np.int64)
                yield nodes[outer], sums, None
            if len(left):
                # one partner a row keeps the tile's rows together: each with its first partner
                r, at = np.unique(right, return_index=True)
                least = left[at]
                yield nodes[r], np.zeros(len(r), dtype=np.int64), self.nodes[least]
                joined = np.unique(np.stack((left, least[np.searchsorted(r, right)])), axis=1)
                self._join(*joined)

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while not np.array_equal(above := label[label], label):
                label[:] = above

    def result(self) -> tuple:
        return self.nodes, self.links, self.nodes[self.label]


def _compare_batches(batches: Iterator[pa.RecordBatch], threshold: float, centres: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, its home rows first; each block is held, the rest streams by."""
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("partner", pa.int64())])
    block = None

    def emit(nodes, links, partners):
        partners = pa.nulls(len(nodes), pa.int64()) if partners is None else pa.array(partners)
        return record_batch(schema, nodes, links, partners)

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {n: batch.column(n).to_numpy() for n in ("cell", "block", "held", "node", "copies", "home")}
        guest_of = batch.column("guest_of").to_pylist() if (columns["held"] == 0).any() else []
        vectors = _vectors(batch.column("vector"))
        runs = np.flatnonzero(
            np.diff(columns["cell"]) | np.diff(columns["block"]) | np.diff(columns["held"])
        )
        cuts = [0, *(runs + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = (int(columns["cell"][a]), int(columns["block"][a]))
            if block is None or block.key != key:
                if block is not None and block.parts:
                    yield emit(*block.result())
                block = _Block(key, threshold, centres)
            part = slice(a, b)
            if columns["held"][a] == 0:
                block.add_home(columns["node"][part], columns["copies"][part], vectors[part], guest_of[part])
                continue
            if not block.parts:  # a cell with guests only
                continue
            if not block.closed:
                block.close_home()
            found = block.compare(
                columns["node"][part], columns["copies"][part], columns["home"][part], vectors[part]
            )
            for row in found:
                yield emit(*row)
    if block is not None and block.parts:
        yield emit(*block.result())


def _usable(vector: str):
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        F.col(vector).isNotNull()
        & F.coalesce(F.forall(vector, finite), F.lit(False))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )


def linked_vectors(
    rows: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    cells: int | None = None,
    exact: bool = True,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows link at a cosine of ``threshold`` or more in double precision; no pair below it does.
    Vectors of different lengths never link. Defined cases: null, zero and empty vectors, and
    those with null or non-finite components, link with nothing and stay; rows of equal vectors link with each
    other whatever their ids; rows that repeat an id are told apart by their vectors; a row without an id links
    like any other, and where a whole group has no id its component is null; other columns of ``rows``
    are not looked at.
    """
    spark = rows.sparkSession
    given = rows.select(
        rows[id].cast("long").alias("vec_id"), rows[vector].cast("array<double>").alias("vector")
    ).withColumn("usable", _usable("vector"))
    given = given.withColumn("vector", F.when(F.col("usable"), F.col("vector")))
    # two 64-bit hashes stand for the content in the joins
    names = [F.xxhash64("vector"), F.xxhash64(F.lit(7), "vector"), F.size("vector")]
    given = given.withColumn("name", F.when(F.col("usable"), F.concat_ws(".", *names)))
    distinct = stored(
        given.where("usable")
        .groupBy("name")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id()),  # of distinct vectors; ids only name what is found
        "vectors",
    )
    sizes = [r[0] for r in distinct.select(F.size("vector")).distinct().collect()]  # lengths, not rows
    found = None
    for size in sizes:
        part = distinct.where(F.size("vector") == size) if len(sizes) > 1 else distinct
        compared = _compared(part, size, threshold, cells, exact)
        found = compared if found is None else found.union(compared)
    if found is None:
        found = spark.createDataFrame([], "node long, links long, partner long")
    found = stored(found, "vector_links")
    joined = components(found.where("partner is not null"), "node", "partner")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    by_node = stored(
        distinct.select("name", "node", "least", "copies")
        .join(counts, "node", "left")
        .join(joined, "node", "left")
        .select(
            "name",
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "linked_vectors",
    )
    ids = by_node.groupBy("component").agg(F.min("least").alias("component_id"))
    by_name = by_node.join(ids, "component").select("name", "n_links", "component_id")
    placed = given.where("usable").select("vec_id", "name").join(by_name, "name").drop("name")
    alone = given.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return placed.select("vec_id", "n_links", "component_id").union(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


def _compared(distinct: DataFrame, size: int, threshold: float, cells: int | None, exact: bool) -> DataFrame:
    """(node, links, partner): parts of each vector's number of links, and spanning links."""
    rows = distinct.count()
    sample = distinct.orderBy(F.xxhash64("name"), "name").select("vector").limit(FIT_ROWS).toArrow()
    k = cells or max(1, min(CENTRES, round(rows / CELL_ROWS)))
    centres = spherical_kmeans(_vectors(sample.column("vector").combine_chunks()), k)
    # half the distance at the threshold; of it, what falls on one direction with 3 deviations
    margin = np.sqrt(2 - 2 * threshold) / 2 * (1.0 if exact else min(1.0, 3 / np.sqrt(size)))
    placed = stored(
        distinct.select("node", "copies", "vector").mapInArrow(
            partial(_place_batches, centres=centres, margin=float(margin)),
            "cell int, home int, node long, copies long, guest_of array<int>, vector array<double>",
        ),
        "cells",
    )
    large = {
        r.cell: r.parts
        for r in placed.where("cell = home")
        .groupBy("cell")
        .agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
        .where("parts > 1")
        .collect()  # at most one row per centre
    }
    parts = F.lit(1)
    if large:
        known = F.create_map(*(F.lit(x) for pair in large.items() for x in pair))
        parts = F.coalesce(known[F.col("cell")], F.lit(1))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    blocks = placed.withColumn("parts", parts)
    homes = blocks.where("cell = home").withColumn("block", own).withColumn("held", F.lit(0))
    streams = blocks.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn(
        "held", F.lit(1)
    )
    columns = ["cell", "block", "held", "node", "copies", "home", "guest_of", "vector"]
    return (
        homes.select(columns)
        .union(streams.select(columns))
        .repartition("cell", "block")
        .sortWithinPartitions("cell", "block", "held")
        .mapInArrow(partial(_compare_batches, threshold=threshold, centres=len(centres)), "node long, links long, partner long")
    )
