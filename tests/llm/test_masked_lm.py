from __future__ import annotations

import random

import numpy as np
import pytest

from ticklake.llm import masked_lm as op

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def corpus(spark):
    """A word is told by its neighbours: a letter's forms follow one another."""
    rng = random.Random(2)
    lines = []
    for i in range(300):
        letters = [rng.choice("abcdefgh") for _ in range(40)]
        lines.append((i, " ".join(f"{x}1 {x}2 {x}3" for x in letters)))
    return lines


def test_learns_from_both_sides(spark, corpus, monkeypatch):
    monkeypatch.setattr(op, "MASKED", 2)
    monkeypatch.setattr(op, "MINIBATCH", 64)
    rng = random.Random(3)
    shuffled = []
    for i, text in corpus[:50]:
        words = text.split()
        rng.shuffle(words)
        shuffled.append((10_000 + i, " ".join(words)))
    docs = spark.createDataFrame(corpus + shuffled, SCHEMA).repartition(3)
    found = {r.doc_id: r.mean_log_likelihood for r in op.scored(docs).collect()}
    real = np.mean([found[i] for i, _ in corpus[:50]])
    mixed = np.mean([found[10_000 + i] for i, _ in corpus[:50]])
    assert real > mixed + 0.5
    assert real > -np.log(24) + 0.5  # better than the words' shares


def test_probabilities_add_up_to_one():
    network = op.Network.fresh(np.arange(op.CODES, dtype=float))
    around = op.contexts(np.array([5, 900, 31]), np.arange(3))
    total = sum(np.exp(network.log_probabilities(around, np.full(3, code))) for code in range(op.CODES))
    assert np.allclose(total, 1, atol=1e-4)


def test_slopes_are_those_of_the_loss():
    """A step moves every weight against its numerical slope."""
    rng = np.random.default_rng(0)
    around, code = rng.integers(op.CODES, size=(6, 2 * op.WINDOW)), rng.integers(op.CODES, size=6)
    network = op.Network.fresh()
    flat = network.flat().astype(np.float64)
    loss = lambda values: -op.Network.unflat(values).log_probabilities(around, code).mean()
    moved = op.Network.unflat(flat)
    ones = [np.full_like(w, 1e12) for w in moved.weights()]  # a rate without scaling
    moved.step(around, code, 1e6, ones)
    slope = flat - moved.flat()
    for at in rng.choice(np.flatnonzero(np.abs(slope) > 1e-3), size=25, replace=False):
        up, down = flat.copy(), flat.copy()
        up[at] += 1e-2
        down[at] -= 1e-2
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(slope[at], rel=0.1, abs=2e-3)


def test_flat_and_back():
    network = op.Network.fresh(seed=4)
    assert np.array_equal(op.Network.unflat(network.flat()).flat(), network.flat())


@pytest.mark.parametrize("size", [0, 1, op.PIECE, 2 * op.PIECE + 3])
def test_score_is_the_sum_over_all_tokens(size):
    network = op.Network.fresh(seed=1)
    codes = np.random.default_rng(size).integers(op.CODES, size=size)
    whole = network.log_probabilities(op.contexts(codes, np.arange(size)), codes).sum() if size else 0
    assert op.document_score(network, codes) == pytest.approx(whole, rel=1e-4)


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b c"), (4, "a b c"), (4, "A  B\tC"), (5, "x y " * 30_000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", codes int, n_tokens int").repartition(1)
    found = op.scored(docs).collect()
    counts = sorted(((r.doc_id, r.n_tokens) for r in found), key=str)
    assert counts == sorted([(1, 0), (2, 0), (3, 0), (None, 3), (4, 3), (4, 3), (5, 60_000)], key=str)
    assert all((r.mean_log_likelihood is None) == (r.n_tokens == 0) for r in found)
    same = [r.log_likelihood for r in found if r.n_tokens == 3]
    assert same == pytest.approx([same[0]] * 3, rel=1e-5)
    assert op.scored(docs.limit(0)).collect() == []
    assert [r.n_tokens for r in op.scored(docs.where("doc_id = 1")).collect()] == [0]


@pytest.mark.parametrize("rounds", [1, 2, 3, 8, 11])
@pytest.mark.parametrize("size", [0, 1, 3, 8, 45])
def test_every_position_is_a_target_once(size, rounds):
    blob = np.arange(size, dtype="<u2").tobytes()
    met = np.concatenate([op.targets(blob, size, round_, rounds) for round_ in range(rounds)])
    assert sorted(met) == list(range(size))


def test_training_covers_all_tokens():
    """Whatever a row's place in its batch, the rounds together train on each token."""
    blobs = [np.arange(n, dtype="<u2").tobytes() for n in (3, 3, 3, 3, 17, 1, 0)]
    batch = op.record_batch(op.pa.schema([("codes", op.pa.binary())]), blobs)
    start = op.Network.fresh().flat().tobytes()
    parts = [next(op._train_batches(iter([batch]), start, r, op.ROUNDS)) for r in range(op.ROUNDS)]
    assert sum(part.column("tokens")[0].as_py() for part in parts) == 30


def test_learns_with_the_registered_settings(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice("abcdefgh") for _ in range(40)]) for i in range(1500)]
    rows = [(i, [f"{x}{n}" for x in letters for n in (1, 2, 3)]) for i, letters in rows]
    mixed = [(10_000 + i, rng.sample(words, len(words))) for i, words in rows[:50]]
    docs = spark.createDataFrame([(i, " ".join(words)) for i, words in rows + mixed], SCHEMA).repartition(2)
    found = {r.doc_id: r.mean_log_likelihood for r in op.scored(docs).collect()}
    real = np.mean([found[i] for i, _ in rows[:50]])
    assert real > np.mean([found[i] for i, _ in mixed]) + 0.5
    assert real > -np.log(24) + 0.5


@pytest.mark.parametrize("held", [op.HELD_BYTES, 1000 * 70, 0])
def test_every_word_has_a_probability_of_its_own(spark, monkeypatch, held):
    """Words that share a code differ by their counts, whether tasks hold them or not."""
    monkeypatch.setattr(op, "HELD_BYTES", held)
    shared, words = {}, [b"w%d" % i for i in range(3000)]
    for word in words[op.CODES - op.OTHER :]:
        shared.setdefault(op.xxhash.xxh64_intdigest(word) % op.OTHER, []).append(word)
    pair = next(group for group in shared.values() if len(group) > 1)[:2]
    counts = {word: 9 for word in words[: op.CODES - op.OTHER]} | {word: 1 for word in words[op.CODES - op.OTHER :]}
    counts[pair[1]] = 5
    text = [" ".join(w.decode() for w, n in counts.items() for _ in range(n) if hash_part(w) == i) for i in range(4)]
    rows = [*enumerate(text), (10, pair[0].decode()), (11, pair[1].decode())]
    found = {r.doc_id: r for r in op.scored(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()}
    assert found[11].log_likelihood - found[10].log_likelihood == pytest.approx(np.log(6 / 2), abs=1e-4)
    assert sum(r.n_tokens for r in found.values()) == sum(counts.values()) + 2


def hash_part(word: bytes) -> int:
    return op.xxhash.xxh64_intdigest(word) % 4


def test_joined_words_score_like_held_ones(spark, corpus, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(f"{rng.choice('abc')}{int(rng.paretovariate(0.6)) % 4000}" for _ in range(60))) for i in range(120)]
    docs = spark.createDataFrame([*rows, (None, "b1 b2"), (3, rows[3][1])], SCHEMA).repartition(3)
    docs = op.stored(docs, "docs")
    whole = sorted(map(tuple, op.scored(docs).collect()), key=str)
    monkeypatch.setattr(op, "HELD_BYTES", 0)
    joined = sorted(map(tuple, op.scored(docs).collect()), key=str)
    assert [r[:2] for r in joined] == [r[:2] for r in whole]
    assert [r[2] for r in joined] == pytest.approx([r[2] for r in whole], abs=1e-3)


def test_contexts_of_many_documents_are_those_of_each(monkeypatch):
    """Documents share one array; a long one passes in pieces that carry their neighbours."""
    monkeypatch.setattr(op, "PIECE", 3)
    rng = np.random.default_rng(4)
    docs = [rng.integers(op.CODES, size=size).astype("<u2") for size in (1, 0, 2, 11, 7)]
    wanted = [np.flatnonzero(rng.random(len(codes)) < 0.6) for codes in docs]
    around, codes = op.contexts_of(*zip(*(p for d, at in zip(docs, wanted) for p in op.pieces_of(d, at)), strict=True))
    padded = [[op.EDGE] * op.WINDOW + d.tolist() + [op.EDGE] * op.WINDOW for d in docs]
    expected = [p[i : i + op.WINDOW] + p[i + op.WINDOW + 1 : i + 2 * op.WINDOW + 1] for p, at in zip(padded, wanted) for i in at]
    assert around.tolist() == expected
    assert codes.tolist() == [int(d[i]) for d, at in zip(docs, wanted) for i in at]


@pytest.mark.parametrize("shift", [0, 500, -500])
def test_shares_of_far_logits(shift):
    """Exponentials that would be infinite or all zero are taken from the largest."""
    logits = np.array([[[1.0], [2.0], [4.0]]], dtype=np.float32)
    found, sums = op._exponentials(logits + np.float32(shift))
    expected = np.exp(logits) / np.exp(logits).sum()
    assert np.allclose(found / sums[:, None], expected, rtol=1e-5)


@pytest.mark.parametrize("scale", [1, 40])
def test_looked_up_neighbours_score_like_the_layers(scale):
    """The scorer's tables give what the layers give, also where exponentials of their sums would be infinite."""
    rng = np.random.default_rng(6)
    network = op.Network.fresh(np.arange(op.CODES, dtype=float), seed=3)
    network.embedding *= scale
    network.inward[-1] = rng.normal(size=op.HIDDEN)
    scorer = op.Scorer(network)
    assert scorer.multiplied == (scale == 1)
    around, code = rng.integers(op.CODES + 1, size=(op.FORWARD + 3, 2 * op.WINDOW)), rng.integers(op.CODES, size=op.FORWARD + 3)
    embedding, inward, first, digit, second = (layer.astype(float) for layer in op._layers(network.values))
    hidden = np.tanh(embedding[around].reshape(len(code), -1) @ inward[:-1] + inward[-1])
    given = np.tanh(hidden + digit[code // op.DIGIT, : op.HIDDEN])
    logs = 0
    for logits, at in (
        (hidden @ first[:-1] + first[-1], code // op.DIGIT),
        (given @ second + digit[code // op.DIGIT, op.HIDDEN :], code % op.DIGIT),
    ):
        logs = logs + logits[np.arange(len(code)), at] - np.log(np.exp(logits).sum(axis=1))
    assert np.allclose(scorer.log_probabilities(around, code), logs, atol=1e-4)


@pytest.mark.parametrize("held", [op.HELD_BYTES, 70 * 1000, 0])
def test_the_most_frequent_words_have_codes_of_their_own(spark, monkeypatch, held):
    """Whether tasks hold these words or not; of words met equally often the smaller ones."""
    monkeypatch.setattr(op, "HELD_BYTES", held)
    own = op.CODES - op.OTHER
    counts = [(b"w%d" % i, 9 if i % 3 else 2) for i in range(1500)]
    words = op.vocabulary(spark.createDataFrame(counts, "word binary, n long"))
    expected = sorted(counts, key=lambda row: (-row[1], row[0]))[:own]
    assert words.held.to_pylist()[:own] == [word for word, _ in expected]


def test_documents_of_a_round_share_positions():
    known = {}
    blobs = [np.arange(size, dtype="<u2").tobytes() for size in (0, 5, 700, 9, op.PIECE + 5)]
    for round_ in range(3):
        known.clear()
        for blob in blobs:
            size = len(blob) // 2
            assert np.array_equal(op.targets(blob, size, round_, 3, known), op.targets(blob, size, round_, 3))
        assert known and all(len(at) <= op.PIECE for at in known.values())
