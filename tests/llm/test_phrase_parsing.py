"""Collocations against plain counting, at every size of chunk and block."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from ticklake.llm import phrase_parsing as op

SCHEMA = "doc_id long, text string, lang string"


def pieces(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split(r"[\x20\x09]+", piece) if w] for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def brute(rows, least=10):
    counts: dict[str, Counter] = {}
    for _, text, lang in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for words in pieces(text):
            for size in (1, 2, 3):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, own in counts.items():
        n = sum(f for words, f in own.items() if len(words) == 1)
        found = {words: f for words, f in own.items() if len(words) > 1 and f >= least}
        gone = {words[i : i + 2] for words, f in found.items() if len(words) == 3 for i in (0, 1) if 100 * f >= 50 * own[words[i : i + 2]]}
        kept = []
        for words, a in found.items():
            if words in gone:
                continue
            score, k = min((1000000 * a * a // (own[words[:k]] * own[words[k:]]), k) for k in range(1, len(words)))
            kept.append((-score, -a, " ".join(words).encode(), own[words[:k]], own[words[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:2000], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def made(seed, docs=120):
    rng = random.Random(seed)
    words = ["the", "of", "Öl", "é\x85x", "New", "York", "x", "a-b", "the of"] + [f"w{i}" for i in range(12)]
    marks = [" ", "  ", "\t", ". ", ",", "\n", "\r\n", "!?"]
    text = lambda: "".join(rng.choice(words) + rng.choices(marks, [9, 1, 1, 1, 1, 1, 1, 1])[0] for _ in range(rng.randint(0, 60)))
    rows = [(i, text(), rng.choice(["en", "en", "en", "de", None, ""])) for i in range(docs)]
    passage = "New York the of a-b " * 30
    rows += [(500 + i, passage, "en") for i in range(40)]
    return rows + [(1, None, None), (None, "", "fr"), (2, " .,;", "en"), (3, "solo " * 3000, "de"), (3, "solo " * 3000, "de")]


def got(spark, rows):
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA + ", n int, chunk string").repartition(3)
    return sorted(map(tuple, op.collocations(docs).collect()))


@pytest.mark.parametrize("trigger, longest, block", [(32, 512, 1 << 20), (3, 7, 50), (1, 1, 400)])
def test_equals_plain_counting(spark, monkeypatch, trigger, longest, block):
    monkeypatch.setattr(op, "TRIGGER", trigger)
    monkeypatch.setattr(op, "CHUNK_WORDS", longest)
    monkeypatch.setattr(op, "BLOCK", block)
    monkeypatch.setattr(op, "NUMBERED", 20 if block < 1000 else op.NUMBERED)
    rows = made(trigger)
    want = brute(rows)
    assert want and got(spark, rows) == want


def test_full_bit_table_only_costs_work(spark, monkeypatch):
    monkeypatch.setattr(op, "TABLE_BITS", 64)
    rows = made(5, 60)
    assert got(spark, rows) == brute(rows)


def test_large_products_are_exact(spark):
    counts = spark.createDataFrame(
        [("en", 1, "a", 3_000_000_019), ("en", 1, "b", 3_000_000_007), ("en", 2, "a b", 2_999_999_999)],
        "lang string, size int, phrase string, n long",
    )
    row = op._scored(counts.where("size = 2").withColumnRenamed("n", "a"), counts).first()
    assert row.score == 1000000 * 2_999_999_999**2 // (3_000_000_019 * 3_000_000_007)


def test_chunks_are_content_defined():
    passage = " ".join(f"p{i}" for i in range(300))
    one = {chunk for _, chunk in op.chunks("before it all " + passage + " end")}
    two = {chunk for _, chunk in op.chunks("x. " + passage + " another end")}
    assert len(one & two) >= len(one) - 3 and len(one) > 4
    own = [own for own, _ in op.chunks("a b, c " * 2000)]
    assert sum(own) == 8000 and max(own) <= op.CHUNK_WORDS


def test_empty_table(spark):
    assert op.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
