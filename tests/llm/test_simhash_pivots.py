from __future__ import annotations

import random
from dataclasses import replace

import pytest
import xxhash
from pyspark.sql import functions as F

from ticklake.llm import simhash_pivots as op

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text: str) -> int:
    """The contract, word for word."""
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints: dict[int, int], radius: int) -> dict[int, int]:
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= radius and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


@pytest.mark.parametrize("size", [0, 1, 3, 4, 5, 300, 70_000])
def test_fingerprint_is_the_contract(size):
    rng = random.Random(size)
    text = " ".join(rng.choice(["The", "ÄB", "x\ty", "Word", "é", "zz"]) for _ in range(size))
    assert op.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(
        "a b c d", 42
    )


def grown(rng, seeds: int, copies: int) -> dict[int, int]:
    prints, number = {}, 0
    for _ in range(seeds):
        centre = rng.getrandbits(64)
        for _ in range(copies):
            flipped = centre
            for bit in rng.sample(range(64), rng.randrange(7)):
                flipped ^= 1 << bit
            prints[number] = flipped
            number += 1
    return prints


@pytest.mark.parametrize("limit", [2048, 20, 2])
def test_links_join_what_brute_force_joins(spark, monkeypatch, limit):
    """Also where blocks are split into sub-blocks, and by further bands."""
    monkeypatch.setattr(op, "PARTS", 3)
    rng = random.Random(7)
    prints = grown(rng, 12, 12) | {900 + i: 0xFFFF0000 + i for i in range(40)}
    signed = {v - 2**64 if v >> 63 else v: v for v in prints.values()}
    rows = spark.createDataFrame([(fp,) for fp in signed], "fp long")
    found = op.components(op.links(rows, replace(op.DOCUMENTS, limit=limit))).collect()
    label = brute_components(signed, 4)
    got = {fp: fp for fp in signed} | {r.node: r.component for r in found}
    groups: dict[int, set] = {}
    for fp in signed:
        groups.setdefault(label[fp], set()).add(got[fp])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(got.values()))


def test_groups_cases(spark):
    text = "one two three four five six seven"
    rows = [(4, text), (2, text.upper()), (9, None), (7, ""), (7, ""), (8, " \t\n"), (None, text), (None, "q"), (5, "lone")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", fp int, node string")
    got = sorted(((r.doc_id, r.component_id) for r in op.groups(docs).collect()), key=str)
    assert got == sorted([(4, 2), (2, 2), (9, 7), (7, 7), (7, 7), (8, 7), (None, 2), (None, None), (5, 5)], key=str)
    assert op.groups(docs.limit(0)).collect() == []


def test_rows_without_id_link(spark):
    """A near copy of a named row belongs to its group, and joins what is near to it on both sides."""
    prints = [0b1111 << 8, 0b1111 << 8 | 0b111, 0b1111 << 8 | 0b111111]
    rows = spark.createDataFrame([(9, prints[0]), (None, prints[1]), (7, prints[2])], "doc_id long, fp long")
    assert {r.component for r in op.components(op.links(rows.select("fp"))).collect()} == {prints[0]}
    words = [f"w{i}" for i in range(400)]
    near = [*words[:200], "changed", *words[201:]]
    assert (op.fingerprint(" ".join(words)) ^ op.fingerprint(" ".join(near))).bit_count() <= 4
    docs = spark.createDataFrame([(7, " ".join(words)), (None, " ".join(near))], SCHEMA)
    assert [r.component_id for r in op.groups(docs).collect()] == [7, 7]


def test_kept_documents(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    near = [*words[:200], "changed", *words[201:]]
    other = [f"w{rng.randrange(5000)}" for _ in range(400)]
    rows = [(i, " ".join(w), i, "x") for i, w in enumerate((words, near, other, words[:200] + other[:200]))]
    rows += [(None, " ".join(words), 8, None), (8, None, None, None), (9, " ", 1, "y")]
    docs = spark.createDataFrame(rows, SCHEMA + ", row long, row_ string").repartition(3)
    kept = op.kept_documents(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).isEmpty()
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [0, 2, 3, 8, None]
    assert op.kept_documents(docs.limit(0)).collect() == []


def test_near_copies_go_by_row(spark):
    """Repeated rows leave one; a clean text stays whatever becomes of another row of its id."""
    words = [f"w{i}" for i in range(600)]
    one, near = " ".join(words), " ".join([*words, "more"])
    assert (op.fingerprint(one) ^ op.fingerprint(near)).bit_count() <= 4
    clean = " ".join(f"other{i}" for i in range(40))
    rows = [(1, one), (1, one), (2, near), (2, clean), (3, near), (4, "a b c d e f"), (4, "a b c d e f"), (None, one), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in op.kept_documents(docs).collect()), key=str)
    assert kept == sorted([(1, one), (2, clean), (4, "a b c d e f"), (None, one), (None, one)], key=str)
