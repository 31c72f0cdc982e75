from __future__ import annotations

import random

import pytest

from ticklake.llm.components import components


def brute(pairs):
    label = {n: n for pair in pairs for n in pair}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize(
    "pairs",
    [
        [],
        [(1, 2), (2, 1), (1, 2)],
        [(i, i + 1) for i in range(60)],
        [(0, i) for i in range(1, 80)] + [(100, i) for i in range(70, 120)],
        [(random.Random(i).randrange(90), random.Random(-i - 1).randrange(90)) for i in range(70)],
    ],
)
def test_equals_brute_force(spark, pairs):
    found = components(spark.createDataFrame([*pairs, (5, 5), (None, 3)], "a long, b long")).collect()
    real = [p for p in pairs if p[0] != p[1]]
    assert {r.node: r.component for r in found} == brute(real)
    assert len(found) == len({n for p in real for n in p})
