from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from ticklake.llm import best_fit as op

SCHEMA = "doc_id long, text string"
LENGTHS = op.Lengths((8, 16, 32))


def naive(sizes, lengths):
    """Best fit by looking at every open bin; of equal room the bin that got that room last."""
    bins, clock, placed, waiting = [], 0, [], sum(sizes)
    for size in sizes:
        clock += 1
        fitting = [b for b in bins if b["room"] >= size]
        if fitting:
            chosen = min(fitting, key=lambda b: (b["room"], -b["since"]))
        else:
            chosen = {"room": lengths.opened(size, waiting), "used": 0, "number": len(bins)}
            bins.append(chosen)
        placed.append((chosen["number"], chosen["used"]))
        chosen["used"] += size
        chosen["room"] -= size
        chosen["since"] = clock
        waiting -= size
    return placed


@pytest.mark.parametrize("seed", range(20))
def test_equals_naive_best_fit(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randrange(1, 33) for _ in range(rng.randrange(200))), reverse=True)
    assert op.pack(sizes, LENGTHS) == naive(sizes, LENGTHS)


def test_bins_open_at_least_cost_and_shrink():
    cheap_small = op.Lengths((8, 32), fixed=0.0, square=1.0)
    cheap_large = op.Lengths((8, 32), fixed=1000.0, square=1e9)
    assert cheap_small.opened(5, 1000) == 8 and cheap_large.opened(5, 1000) == 32
    assert cheap_large.opened(5, 6) == 8  # little is left to fill it with
    assert op.used_lengths([5, 2], [(0, 0), (0, 5)], LENGTHS) == [8]
    assert op.used_lengths([], [], LENGTHS) == []
    for wrong in ((), (0, 4), (4, 2), (4, 4)):
        with pytest.raises(ValueError, match="permitted"):
            op.Lengths(wrong)


def check_places(places, tokens: dict):
    bins, docs = defaultdict(list), defaultdict(list)
    for r in places:
        bins[r.share, r.bin].append(r)
        docs[r.doc_id].append(r)
    for rows in bins.values():
        rows.sort(key=lambda r: r.offset)
        end = 0
        for r in rows:
            assert r.offset == end  # without gaps
            end += r.length
        assert rows[0].capacity == LENGTHS.shrunk(end)
        assert len({r.capacity for r in rows}) == 1
    for doc, rows in docs.items():
        rows.sort(key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows)))
        assert [r.start for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))]
        assert sum(r.length for r in rows) == tokens[doc]
    assert set(docs) == {d for d, n in tokens.items() if n}


def test_packing_keeps_every_token(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([0, 1, 7, 8, 20, 32, 33, 150])) for i in range(300)] + [(1000, None), (1001, "a\tb\nc")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", share int, tokens int").repartition(3)
    places = op.packing(docs, LENGTHS, share_rows=100).collect()
    check_places(places, {i: len((t or "").split()) for i, t in rows})
    assert places == op.packing(docs.repartition(5), LENGTHS, share_rows=100).collect() or sorted(places) == sorted(
        op.packing(docs.repartition(5), LENGTHS, share_rows=100).collect()
    )


def test_cases(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "c"), (7, "d"), (7, "d"), (8, "x " * 100_000)], SCHEMA)
    places = op.packing(docs, LENGTHS).collect()
    assert sum(r.length for r in places) == 100_005
    assert sorted(r.length for r in places if r.doc_id is None) == [1, 2]
    assert len([r for r in places if r.doc_id == 7]) == 2
    assert op.packing(docs.limit(0), LENGTHS).collect() == []


def test_rows_that_repeat_are_cut_into_shares(spark):
    docs = spark.createDataFrame([(None, "a b c")] * 90 + [(5, "d")] * 30 + [(6, "x " * 70)], SCHEMA)
    places = op.packing(docs, LENGTHS, share_rows=10).collect()
    shares = Counter(r.share for r in places)
    assert sum(shares.values()) == 123 and max(shares.values()) <= 10 * op.CUT + 2
    assert sum(r.length for r in places) == 90 * 3 + 30 + 70
    bins = defaultdict(int)
    for r in places:
        bins[r.share, r.bin, r.capacity] += r.length
    assert all(used <= capacity for (_, _, capacity), used in bins.items())
    assert sorted(places, key=str) == sorted(op.packing(docs.repartition(7), LENGTHS, share_rows=10).collect(), key=str)
