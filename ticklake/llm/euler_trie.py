"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns. Members, and with them a node's smallest member,
come from one aggregate over prefix digests; smallest member and depth name a node from
there on. Nodes are numbered by a distributed sort in which siblings are neighbours. Each node has an
enter and an exit arc: entering leads to the first child or to the own exit, leaving to the
next sibling or to the parent's exit. The tour is this linked list, and it is ranked without following it
from end to end: arcs are dealt out, each task joins the runs of the list that it holds into single
arcs, and the shorter list goes on in another deal until the rest is small; the joined arcs then
get their places back, level by level. The first deal is by conversation, where most of the tour is
local; in later ones a coin decides for each arc whether it goes to its successor's task, so a
quarter of the list vanishes each time whatever its order. A subtree's leaves and savings are the
difference of the prefix sums at its exit and enter arcs.

No step gathers a conversation, a node's children or its members in one place: long
conversations are sorted and digested in slices, and the ends of a node are joined to texts in
sorted pieces before one digest reads the pieces in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import record_batch, stored

#: Conversations whose first turns are those of the first one among them, and the bound of how many.
SHARED = 100
TURNS = 6

#: Turns of a conversation digested in one piece; the pieces' digests are chained.
SLICE = 4096

#: Arcs dealt to a task, and arcs left over for one last task: constants, whatever the input.
ARCS = 1 << 16
REST = 1 << 12

#: Characters of member ids joined in one piece.
PIECE = 1 << 16

#: Digest of the empty sequence.
ROOT = b"\0" * 16


def numbered(rows: DataFrame, *keys: Column, name: str = "numbered") -> DataFrame:
    """The rows in the order of ``keys``, with their place in ``at`` (from 0); stored.

    A distributed sort; only the number of rows of each of its partitions is gathered.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    held = stored(spread.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    sizes = sorted(map(tuple, held.groupBy(part.alias("part")).count().collect()))  # one row per partition
    before, first = [], 0
    for number, size in sizes:
        before.append((number, first - (number << 33)))
        first += size
    shift = F.broadcast(spark.createDataFrame(before, "part long, shift long"))  # as many rows as partitions
    return held.withColumn("part", part).join(shift, "part").withColumn("at", F.col("at") + F.col("shift")).drop("part", "shift")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every conversation as rebuilt, and its (conv_id, depth, role, text) turns."""
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # rows that agree in all of these are the same row twice, and their order is of no account
    turns = turns.withColumn("row", F.monotonically_increasing_id())
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text"), F.col("row")]
    sorted_turns = numbered(turns, *order, name="turns").drop("turn", "row")
    spans = stored(sorted_turns.groupBy("conv_id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size")), "spans")
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % TURNS
    base = F.col("conv_id") - F.col("conv_id") % SHARED
    bases = spans.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    convs = spans.withColumns({"kept": kept, "base": base}).join(bases, "base", "left").select(
        "conv_id", "first", "size", "kept", "base", F.least("kept", F.coalesce("base_size", F.lit(0))).alias("taken")
    )
    convs = stored(convs, "conversations")
    lengths = convs.select(
        "conv_id", (F.col("taken") + F.greatest(F.col("size") - F.col("kept"), F.lit(0))).alias("length")
    )
    place = F.col("at") - F.col("first")
    own = sorted_turns.join(convs, "conv_id").where(place >= F.col("kept")).select(
        "conv_id", (F.col("taken") + place - F.col("kept") + 1).alias("depth"), "role", "text"
    )
    # at most TURNS - 1 turns of a base, each for the conversations that share it
    opening = (
        sorted_turns.where(F.col("conv_id") % SHARED == 0)
        .join(spans, "conv_id")
        .where(place < TURNS - 1)
        .select(F.col("conv_id").alias("base"), place.alias("place"), "role", "text")
    )
    shared = opening.join(convs, "base").where(F.col("place") < F.col("kept")).select(
        "conv_id", (F.col("place") + 1).alias("depth"), "role", "text"
    )
    return lengths, own.unionByName(shared)


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each slice's prefixes; rows come by conversation, slice and depth."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("part", pa.int64()), ("depth", pa.int64())]
        + [("digest", pa.binary()), ("parent", pa.binary()), ("chars", pa.int64())]
    )
    key, held = None, ROOT
    for batch in batches:
        convs, parts, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "part", "role", "text"))
        digests, parents = [], []
        for conv, part, role, text in zip(convs, parts, roles, texts, strict=True):
            if (conv, part) != key:
                key, held = (conv, part), ROOT
            parents.append(held)
            role_bytes = role.encode()
            turn = len(role_bytes).to_bytes(8, "big") + role_bytes + text.encode()
            held = hashlib.sha256(held + turn).digest()[:16]
            digests.append(held)
        chars = [len(text) for text in texts]
        yield record_batch(schema, batch.column("conv_id"), batch.column("part"), batch.column("depth"), digests, parents, chars)


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefix before each slice but the first of a conversation; (conv_id, part, last) rows in order.

    A prefix that goes beyond the first slice has the digest of ``start`` and of its own in the slice.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("start", pa.binary())])
    conv, before = None, b""
    for batch in batches:
        out: list[tuple] = []
        for own, part, last in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "last")), strict=True):
            if own != conv:
                conv, before = own, last
            else:
                out.append((own, part, before))
                before = hashlib.sha256(before + last).digest()[:16]
        yield record_batch(schema, *([row[i] for row in out] for i in range(3)))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, parent, chars) of every prefix of every rebuilt conversation; stored."""
    sliced = turns.withColumn("part", F.floor((F.col("depth") - 1) / SLICE))
    local = stored(
        sliced.repartition("conv_id", "part")
        .sortWithinPartitions("conv_id", "part", "depth")
        .select("conv_id", "part", "depth", "role", "text")
        .mapInArrow(_digest_batches, "conv_id long, part long, depth long, digest binary, parent binary, chars long"),
        "digests",
    )
    first = local.where("part = 0").select("conv_id", "depth", "digest", "parent", "chars")
    if local.where("part > 0").isEmpty():
        return first
    # a row for each SLICE turns, of conversations that have more
    ends = local.where(F.col("depth") % SLICE == 0).select("conv_id", "part", F.col("digest").alias("last"))
    open_ends = local.where("part > 0").groupBy("conv_id", "part").agg(F.max_by("digest", "depth").alias("last"))
    every = ends.where("part = 0").union(open_ends)
    starts = (
        every.repartition("conv_id")
        .sortWithinPartitions("conv_id", "part")
        .mapInArrow(_chain_batches, "conv_id long, part long, start binary")
    )
    whole = lambda name: F.unhex(F.substring(F.sha2(F.concat("start", name), 256), 1, 32))
    later = (
        local.where("part > 0")
        .join(stored(starts, "slice_starts"), ["conv_id", "part"])
        .select(
            "conv_id",
            "depth",
            whole("digest").alias("digest"),
            F.when((F.col("depth") - 1) % SLICE == 0, F.col("start")).otherwise(whole("parent")).alias("parent"),
            "chars",
        )
    )
    return stored(first.unionByName(later), "prefixes")


def tree(lengths: DataFrame, prefix: DataFrame) -> DataFrame:
    """The nodes, numbered so that siblings are neighbours; stored.

    (at, conv_id, depth, parent_conv_id, n_convs, chars, digest)
    """
    inner = prefix.groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        F.max("chars").alias("chars"),
    )
    inner = stored(inner, "nodes")
    least, count = lengths.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    root = [(ROOT, least, count, 0, 0, None)] if count else []
    root = lengths.sparkSession.createDataFrame(
        root, "digest binary, conv_id long, n_convs long, depth long, chars long, parent_conv_id long"
    )
    parents = inner.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    deep = inner.where("depth > 1").join(parents, "parent").drop("parent")
    top = inner.where("depth = 1").drop("parent").withColumn("parent_conv_id", F.lit(least).cast("long"))
    nodes = deep.unionByName(top).unionByName(root)
    return numbered(nodes, F.asc_nulls_first("parent_conv_id"), F.col("depth"), F.col("conv_id"), name="tree")


def arcs(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tour: (arc, next, home, steps, leaves, saved), where node i has the arcs 2 i and 2 i + 1; and each inner node's children.

    ``home`` is the conversation by which the first deal goes.
    """
    families = stored(
        nodes.where("parent_conv_id is not null")
        .groupBy("parent_conv_id", "depth")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n_children")),
        "families",
    )
    inner = stored(
        families.withColumn("depth", F.col("depth") - 1)
        .withColumnRenamed("parent_conv_id", "conv_id")
        .join(nodes.select("at", "conv_id", "depth"), ["conv_id", "depth"])
        .select("at", "first", "n_children"),
        "inner",
    )
    lasts = inner.select((F.col("first") + F.col("n_children") - 1).alias("at"), F.col("at").alias("up"))
    saved = (F.col("n_convs") - 1) * F.col("chars")
    placed = nodes.join(inner.select("at", "first"), "at", "left").join(lasts, "at", "left")
    enter = placed.select(
        (2 * F.col("at")).alias("arc"),
        F.coalesce(2 * F.col("first"), 2 * F.col("at") + 1).alias("next"),
        F.col("conv_id").alias("home"),
        F.lit(1).cast("long").alias("steps"),
        F.col("first").isNull().cast("long").alias("leaves"),
        saved.alias("saved"),
    )
    after = F.when(F.col("up").isNotNull(), 2 * F.col("up") + 1).when(F.col("depth") > 0, 2 * F.col("at") + 2)
    none = F.lit(0).cast("long")
    leave = placed.select(
        (2 * F.col("at") + 1).alias("arc"),
        after.alias("next"),
        F.col("conv_id").alias("home"),
        F.lit(1).cast("long").alias("steps"),
        none.alias("leaves"),
        none.alias("saved"),
    )
    return stored(enter.union(leave), "arcs"), inner


RUNS = "arc long, head long, next long, home long, steps long, leaves long, saved long"
WEIGHTS = ("steps", "leaves", "saved")


def joined_runs(arc: np.ndarray, after: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each arc the head of its run, what lies between head and arc, and the arc's successor if its run ends there.

    A run is a path of the list whose arcs are all here. By pointer jumping towards the heads:
    log2 of the longest run many rounds of array operations. ``after`` is -1 at the end of the list.
    """
    order = np.argsort(arc)
    found = np.searchsorted(arc, after, sorter=order)
    follower = order[np.minimum(found, len(arc) - 1)]
    is_here = arc[follower] == after
    back = np.full(len(arc), -1)
    back[follower[is_here]] = np.flatnonzero(is_here)
    between = np.where((back >= 0)[:, None], weights[back], 0)
    head = np.where(back >= 0, back, np.arange(len(arc)))
    while True:
        further = head[head]
        if (further == head).all():
            break
        between = between + between[head]
        head = further
    return head, between, ~is_here


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined arcs (with ``next`` set or -1, and the whole run's weights) and, without ``home``, the arcs they swallowed."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    arc, after, home = (table.column(c).to_numpy() for c in ("arc", "next", "home"))
    weights = np.stack([table.column(c).to_numpy() for c in WEIGHTS], axis=1)
    head, between, ends = joined_runs(arc, after, weights)
    schema = pa.schema([(c.split()[0], pa.int64()) for c in RUNS.split(", ")])
    tail = np.flatnonzero(ends)
    whole = between[tail] + weights[tail]
    yield record_batch(schema, arc[head[tail]], arc[head[tail]], after[tail], home[head[tail]], *whole.T)
    inner = np.flatnonzero(head != np.arange(len(arc)))
    none = pa.nulls(len(inner), pa.int64())
    yield record_batch(schema, arc[inner], arc[head[inner]], none, none, *between[inner].T)


def _joined(list_: DataFrame, round_: int) -> DataFrame:
    """One deal of the list, joined within its tasks; stored."""
    parts = -(-list_.count() // ARCS)
    if round_ == 0:
        dealt = list_.repartitionByRange(parts, "home", "arc")
    else:
        coin = F.xxhash64(F.col("arc"), F.lit(round_)) % 2 == 0
        dealt = list_.repartition(parts, F.when(coin & (F.col("next") >= 0), F.col("next")).otherwise(F.col("arc")))
    return stored(dealt.mapInArrow(_run_batches, RUNS), "runs")


def ranked(list_: DataFrame) -> DataFrame:
    """(arc, steps, leaves, saved): the weights of all arcs before each arc of a linked list.

    ``list_`` has (arc, next, home, steps, leaves, saved), null as the last arc's ``next``.
    """
    left = list_.withColumn("next", F.coalesce("next", F.lit(-1).cast("long")))
    levels = []
    while True:
        runs = _joined(left, len(levels))
        levels.append(runs.where("home is null").select("arc", "head", *WEIGHTS))
        left = runs.where("home is not null").drop("head")
        if left.count() <= REST:
            break
    rest = left.coalesce(1).mapInArrow(_run_batches, RUNS)  # REST arcs at most: one run now
    places = rest.select(
        "arc", *(F.when(F.col("home").isNull(), F.col(c)).otherwise(0).cast("long").alias(c) for c in WEIGHTS)
    )
    places = stored(places, "places")
    for inner in reversed(levels):
        heads = places.select(F.col("arc").alias("head"), *(F.col(c).alias(f"head_{c}") for c in WEIGHTS))
        more = inner.join(heads, "head").select("arc", *((F.col(c) + F.col(f"head_{c}")).alias(c) for c in WEIGHTS))
        places = stored(places.unionByName(more), "places")
    return places


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv_id) rows to pieces of comma-joined ids."""
    schema = pa.schema([("digest", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    key, first, ids, size = None, 0, [], 0
    for batch in batches:
        out = []
        for digest, conv in zip(batch.column("digest").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if digest != key or size > PIECE:
                if ids:
                    out.append((key, first, ",".join(ids)))
                key, first, ids, size = digest, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield record_batch(schema, *([row[i] for row in out] for i in range(3)))
    if ids:
        yield record_batch(schema, [key], [first], [",".join(ids)])


def _end_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node over its pieces in order; a digest takes its bytes one after the other."""
    schema = pa.schema([("digest", pa.binary()), ("ends_sha256", pa.string())])
    key, state = None, None
    for batch in batches:
        out = []
        for digest, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if digest != key:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = digest, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield record_batch(schema, *([row[i] for row in out] for i in range(2)))
    if state is not None:
        yield record_batch(schema, [key], [state.hexdigest()])


def ends(lengths: DataFrame, prefix: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of nodes at which conversations end."""
    parts = int(lengths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = prefix.groupBy("conv_id").agg(F.max_by("digest", "depth").alias("digest"))
    bare = lengths.where("length = 0").select("conv_id", F.lit(ROOT).alias("digest"))
    pieces = (
        last.unionByName(bare)
        .repartitionByRange(parts, "digest", "conv_id")
        .sortWithinPartitions("digest", "conv_id")
        .mapInArrow(_piece_batches, "digest binary, first long, ids string")
    )
    return pieces.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(
        _end_batches, "digest binary, ends_sha256 string"
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rebuilt first, see ``rebuilt``. Defined cases: null roles and texts are
    empty, a null turn comes first; rows of equal turn go by role, then text, and repeated rows are
    turns of their own; rows without conv_id belong to no conversation; without any conversation there
    is no node, also no root; other columns of ``conversations`` are not looked at.
    """
    lengths, turns = rebuilt(conversations)
    lengths = stored(lengths, "lengths")
    prefix = prefixes(turns)
    nodes = tree(lengths, prefix)
    if nodes.isEmpty():
        nothing = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        return conversations.sparkSession.createDataFrame([], nothing)
    tour, inner = arcs(nodes)
    places = ranked(tour)
    at = F.shiftright("arc", 1).alias("at")
    entered = places.where("arc % 2 = 0").select(at, F.col("leaves").alias("leaves_in"), F.col("saved").alias("saved_in"))
    left = places.where("arc % 2 = 1").select(at, F.col("leaves").alias("leaves_out"), F.col("saved").alias("saved_out"))
    empty = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(entered, "at")
        .join(left, "at")
        .join(inner.select("at", "n_children"), "at", "left")
        .join(stored(ends(lengths, prefix), "ends"), "digest", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            (F.col("leaves_out") - F.col("leaves_in")).alias("n_leaves"),
            (F.col("saved_out") - F.col("saved_in")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )
