from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from ticklake.llm import spherical_cells as op

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors: np.ndarray, threshold: float = 0.95) -> tuple[np.ndarray, np.ndarray]:
    x = op.normalised(vectors)
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(x)).min(axis=1))
        if np.array_equal(least, label):
            return linked.sum(axis=1), label
        label = least


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(700, 32))
    near = base[rng.integers(700, size=500)] + rng.normal(size=(500, 32)) * rng.uniform(0.02, 0.35, size=(500, 1))
    hot = np.repeat(base[:1], 300, axis=0)
    crowd = base[5] + rng.normal(size=(300, 32)) * 0.17
    return np.concatenate([base, near, hot, crowd]).astype(np.float32)


def result(spark, vectors, **options):
    frame = pd.DataFrame({"vec_id": np.arange(len(vectors)), "embedding": vectors.tolist()})
    rows = spark.createDataFrame(frame, SCHEMA).repartition(5)
    return op.linked_vectors(rows, **options).toPandas().sort_values("vec_id")


@pytest.mark.parametrize("block", [2048, 100])
def test_exact_equals_brute_force(spark, vectors, monkeypatch, block):
    """Also where a cell is split into blocks."""
    monkeypatch.setattr(op, "BLOCK", block)
    links, label = brute(vectors)
    found = result(spark, vectors, cells=7, exact=True)
    assert found.n_links.tolist() == links.tolist()
    assert found.component_id.tolist() == label.tolist()
    assert found.kept.tolist() == (found.vec_id == found.component_id).tolist()


def test_recall_of_the_default_margin(spark, vectors):
    links, _ = brute(vectors)
    found = result(spark, vectors, cells=25)
    assert (found.n_links.to_numpy() <= links).all()
    assert found.n_links.sum() >= 0.99 * links.sum()


def test_cases(spark):
    rows = [
        (1, None),
        (2, [0.0] * 3),
        (3, [1.0, None, 2.0]),
        (4, [float("nan"), 1.0, 1.0]),
        (10, [float("inf"), 1.0, 1.0]),
        (5, [1.0, 2.0, 3.0]),
        (5, [1.0, 2.0, 3.0]),
        (6, [2.0, 4.0, 6.0]),
        (None, [1.0, 2.0, 3.0]),
        (8, []),
        (9, [1.0, 2.0]),
        (11, [1e-30, 2e-30, 3e-30]),
    ]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA.replace("float", "double") + ", node int, home int")
    found = sorted((tuple(r) for r in op.linked_vectors(table).collect()), key=str)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 8, 9, 10)]
    joined = [(5, 4, 5, True), (5, 4, 5, True), (6, 4, 5, False), (11, 4, 5, False), (None, 4, 5, False)]
    assert found == sorted(alone + joined, key=str)
    assert op.linked_vectors(table.limit(0)).collect() == []


def test_repeated_ids_are_told_apart_by_their_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0])]
    rows += [(None, [0.0, 0.0, 1.0]), (None, [0.0, 0.01, 1.0]), (7, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.01])]
    found = op.linked_vectors(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    want = [(1, 1, 1, True), (1, 0, 1, True), (2, 1, 1, False), (None, 1, None, True), (None, 1, None, True)]
    assert sorted(map(tuple, found), key=str) == sorted([*want, (7, 1, 7, True), (None, 1, 7, False)], key=str)


def test_centres_are_of_length_one():
    rng = np.random.default_rng(2)
    centres = op.spherical_kmeans(rng.normal(size=(50, 8)), 10)
    assert centres.shape == (10, 8)
    assert np.allclose((centres**2).sum(axis=1), 1)
    assert len(op.spherical_kmeans(np.ones((3, 4)), 10)) == 3


@pytest.mark.parametrize("rank", [4, 8, 16])
def test_default_is_exact_on_low_rank_vectors(spark, rank):
    """Near pairs inside a subspace, over several cells."""
    rng = np.random.default_rng(rank)
    base = rng.normal(size=(600, rank))
    near = base[rng.integers(600, size=900)] + rng.normal(size=(900, rank)) * rng.uniform(0.05, 0.35, size=(900, 1))
    low = (np.concatenate([base, near]) @ rng.normal(size=(rank, 64))).astype(np.float32)
    links, label = brute(low)
    found = result(spark, low, cells=12)
    assert found.n_links.tolist() == links.tolist()
    assert found.component_id.tolist() == label.tolist()
