from __future__ import annotations

import zlib

import numpy as np
import pytest

from ticklake.llm import toxicity_trees as op

SCHEMA = "doc_id long, text string"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    scores = op.scored(docs, op.fit(docs, labels)).toPandas()
    assert len(scores) == docs.count() and scores.score.between(0, 1).all()
    assert (scores.predicted == (scores.score >= 0.5)).all()
    assert (scores.held_out == scores.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    known = scores.merge(labels.toPandas(), on="doc_id")
    known = known[known.held_out]
    hits = ((known.predicted == 1) & (known.toxic == 1)).sum()
    assert hits / (known.predicted == 1).sum() > 0.95
    assert hits / (known.toxic == 1).sum() > 0.85


def test_held_out_labels_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"plain words {'nasty' if i % 3 == 0 else 'nice'} here") for i in range(400)], SCHEMA)
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 3 = 0 AS int) AS toxic")
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS string)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    first, second = (op.scored(docs, op.fit(docs, rows)).orderBy("doc_id").collect() for rows in (labels, turned))
    assert first == second
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in first)


def test_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (None, "you"), (2, None)], SCHEMA)
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    found = op.scored(docs, op.fit(docs, none)).collect()
    assert [(r.score, r.predicted) for r in found] == [(0.0, 0)] * 4
    assert [r.held_out for r in found if r.doc_id is None] == [True]
    empty = docs.limit(0)
    assert op.scored(empty, op.fit(empty, none)).collect() == []


def test_cleaning_keeps_all_columns(spark):
    rows = [(i, "you nasty thing" if i % 2 else "a quiet day", "x", 1) for i in range(200)] + [(None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA + ", score string, half int")
    labels = spark.range(200).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic", "1 AS half").union(
        spark.sql("SELECT 7L, 1, 1 UNION ALL SELECT 7L, 1, 1")
    )
    kept = op.clean_documents(docs, labels)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i in [*range(0, 200, 2), None])


def test_features_cover_whole_texts():
    lexicon = {"nasty": 5.0, "^horrib": 3.0}
    clean = "word " * 300_000
    assert op.features("", lexicon) == [0.0] * len(op.FEATURES)
    named = lambda text: dict(zip(op.FEATURES, op.features(text, lexicon), strict=True))
    assert named(clean)["hits"] == 0
    assert named(clean + "you NASTY horribly one")["distinct_hits"] == 1
    assert named(clean + "you NASTY horribly one")["stem_hits"] > 0
    assert named("you are nasty")["nearest_second_person"] > named("you are not so very nasty")["nearest_second_person"]
    assert named("n4sty")["disguised_hits"] > 0
    assert named("n a s t y")["spaced"] > 0 and named("naaasty")["stretched"] > 0
    assert named("SHOUT LOUD")["capitals"] == 1


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(20):
        x, y = rng.permutation(12).astype(float), rng.integers(0, 2, size=12).astype(float)
        at, value = op.isotonic(x, y)
        assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
        # the closest non-decreasing curve is the largest of the smallest means to the right
        order = y[np.argsort(x)]
        want = [max(min(order[i : j + 1].mean() for j in range(k, 12)) for i in range(k + 1)) for k in range(12)]
        assert len(value) == len(np.unique(np.round(want, 9)))
        assert np.allclose(np.unique(np.round(want, 9)), value, atol=0.05)


@pytest.mark.parametrize("seed", range(3))
def test_trees_learn_an_interaction(seed):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, size=(3000, 4))
    y = ((x[:, 0] > 0.2) & (x[:, 2] < 0.3)).astype(float)
    trees = op.Trees().fit(x[:2000], y[:2000])
    assert ((trees.margin(x[2000:]) > 0) == (y[2000:] > 0.5)).mean() > 0.97


def test_rare_terms_are_not_learned():
    assert op._lexicon(np.array([[5.0, 1.0], [0.0, 3.0]]), ["a", "b"], 10, 90) == {}
