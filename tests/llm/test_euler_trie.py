"""The prefix trie against a plain one, at every size of slice, deal and piece."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from ticklake.llm import euler_trie as op

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [row[2:] for row in sorted(found)] for conv, found in own.items()}
    members: dict[tuple, list[int]] = {}
    ends: dict[tuple, list[int]] = {}
    for conv in sorted(turns):
        kept = zlib.crc32(str(conv).encode()) % 6
        whole = tuple(turns.get(conv - conv % 100, [])[:kept] + turns[conv][kept:])
        for depth in range(len(whole) + 1):
            members.setdefault(whole[:depth], []).append(conv)
        ends.setdefault(whole, []).append(conv)
    children: dict[tuple, int] = {}
    for key in members:
        if key:
            children[key[:-1]] = children.get(key[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for key, found in members.items():
        for depth in range(len(key) + 1):
            leaves[key[:depth]] += key not in children
            saved[key[:depth]] += (len(found) - 1) * len(key[-1][1]) if key else 0
    out = []
    for key, found in members.items():
        parent = members[key[:-1]][0] if key else None
        digest = hashlib.sha256(",".join(map(str, ends.get(key, []))).encode()).hexdigest()
        out.append((found[0], len(key), parent, len(found), children.get(key, 0), leaves[key], saved[key], digest))
    return sorted(out, key=str)


def made(seed, convs=160, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(convs * 2), convs):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([turn, turn, 0, None]), rng.choice(["user", "bot", None]), rng.choice(["", "hi", "é😀", None, "so"])))
    rows += [(1000 + i, t, "user", f"same {t}") for i in range(130) for t in range(7)]  # a hot conversation
    rows += [(5000, t, "bot", f"turn {t}") for t in range(60)] + [(5001, t, "bot", f"turn {t}") for t in range(59)]
    rows += [(2000 + i, 0, "user", str(i)) for i in range(90)]  # many children of one node
    rows += [(None, 1, "user", "lost"), (7, 1, "user", "x"), (7, 1, "user", "x"), (8, 0, "long", "y" * 300_000)]
    rng.shuffle(rows)
    return rows


def got(spark, rows):
    table = spark.createDataFrame([(*r, 3, b"x") for r in rows], SCHEMA + ", at long, digest binary").repartition(5)
    return sorted((tuple(r) for r in op.prefix_trie(table).collect()), key=str)


@pytest.mark.parametrize("slice_, arcs, rest, piece", [(4096, 1 << 16, 1 << 12, 1 << 16), (3, 300, 40, 10), (1, 60, 1, 1)])
def test_equals_a_plain_trie(spark, monkeypatch, slice_, arcs, rest, piece):
    for name, value in (("SLICE", slice_), ("ARCS", arcs), ("REST", rest), ("PIECE", piece)):
        monkeypatch.setattr(op, name, value)
    rows = made(slice_)
    assert got(spark, rows) == brute(rows)


def test_only_openings(spark):
    """Conversations that are left without turns are members of the root."""
    rows = [(c, 0, "user", "x") for c in range(101, 140)]
    want = brute(rows)
    assert got(spark, rows) == want and want[0][1] == 0


def test_one_row_and_none(spark):
    assert got(spark, [(None, 1, "a", "b")]) == []
    assert got(spark, [(300, None, None, None)]) == brute([(300, None, None, None)])
    assert op.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("rest", [1, 30])
def test_ranks_of_a_scattered_list(spark, monkeypatch, rest):
    """No deal is local here; the coin alone shortens the list."""
    monkeypatch.setattr(op, "ARCS", 100)
    monkeypatch.setattr(op, "REST", rest)
    rng = random.Random(3)
    order = rng.sample(range(10_000), 700)
    rows = [(a, b, rng.randrange(1 << 40), 1, a % 3, a) for a, b in zip(order, [*order[1:], None], strict=True)]
    found = op.ranked(spark.createDataFrame(rows, "arc long, next long, home long, steps long, leaves long, saved long"))
    leaves = np.cumsum([0] + [a % 3 for a in order]).tolist()
    saved = np.cumsum([0] + order).tolist()
    want = {a: (i, leaves[i], saved[i]) for i, a in enumerate(order)}
    assert {r.arc: (r.steps, r.leaves, r.saved) for r in found.collect()} == want


def test_numbers_follow_the_order(spark):
    rows = spark.range(0, 1000, 1, 7).selectExpr("id * 7919 % 1000 AS key")
    from pyspark.sql import functions as F

    found = op.numbered(rows, F.col("key"))
    assert sorted((r.key, r.at) for r in found.collect()) == [(i, i) for i in range(1000)]
