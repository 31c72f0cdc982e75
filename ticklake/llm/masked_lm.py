"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network predicts each token from the ``WINDOW`` tokens on either side: their embeddings pass
one hidden layer, and the token's code comes out in two digits, the second given the first, so the
probabilities over all codes add up to one. The most frequent words have codes of their own; the
others share codes by a hash, and each has its share of its code's occurrences as its probability
given the code. So every distinct word has a probability of its own, and they add up to one. A
document's score is the sum of its tokens' conditional log-probabilities.

The counts of all distinct words are a stored table. Every task holds those above a minimum count,
by which they fit ``HELD_BYTES``; the other words of a document are joined with the table.

Training is data-parallel: in each round every task starts from the same weights, trains on masked
positions of all its documents, and hands back its weights with the number of tokens behind them;
their weighted mean starts the next round. Over the rounds every position of every document is
a target once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import record_batch, sliced, stored, text_of

#: Tokens seen on each side.
WINDOW = 2

#: Codes: DIGIT * DIGIT of them; the last OTHER are shared by words that have none of their own. They
#: are what the network tells apart; the words themselves are not limited.
DIGIT = 32
OTHER = 128
CODES = DIGIT * DIGIT

#: Stands for what lies beyond the ends of a document.
EDGE = CODES

#: Sizes of the network, and its training: every MASKED-th token is masked at a time, and the
#: MASKED shifts of this mask are dealt out over the rounds.
EMBEDDING = 12
HIDDEN = 48
ROUNDS = 2
MASKED = 8
RATE = 0.03
MINIBATCH = 256

#: Groups of tasks whose weights are averaged before the driver averages the groups.
AVERAGED = 32

#: Tokens that are scored at a time: enough that calls take no time beside the work, few enough for the caches.
FORWARD = 2048

#: Tokens gathered to be scored.
PIECE = 1 << 14

#: Bytes of text split into words at a time.
SPLIT_BYTES = 1 << 24

#: Bytes of words, with 64 for each, whose counts every task holds; the minimum count follows.
HELD_BYTES = 24 << 20


def words_of(texts: pa.StringArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """Words of many texts in lower case (A-Z), split at ASCII white space, and where each text's begin and all end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten().cast(pa.binary())
    stays = pc.greater(pc.binary_length(words), 0)  # white space at an end splits off an empty word
    ends = np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))
    starts = np.concatenate(([0], np.cumsum(stays.to_numpy(zero_copy_only=False), dtype=np.int64)))
    return words.filter(stays), starts[np.concatenate(([0], ends))]


@dataclass
class Words:
    """Words that tasks hold; behind them a place for each shared code: codes, and logarithms of counts.

    A word with a code of its own has the logarithm 0. ``joined`` tells whether words that are not
    held, and met more than once, are to be looked up in the table of all words.
    """

    held: pa.BinaryArray
    code: np.ndarray
    log_count: np.ndarray
    joined: bool


    def places(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words, those that are not held by their hash; and which these are."""
        found = pc.index_in(words, value_set=self.held)
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        away = at < 0
        others = words.filter(pa.array(away)).dictionary_encode()
        hashes = map(xxhash.xxh64_intdigest, others.dictionary.to_numpy(zero_copy_only=False))
        shared = np.fromiter(hashes, dtype=np.uint64, count=len(others.dictionary)) % np.uint64(OTHER)
        at[away] = len(self.held) + shared.astype(np.int64)[others.indices.to_numpy()]
        return at, away


#: Layers of the network, one behind the other in its flat array. The last row of ``inward`` and of
#: ``first`` is a bias; ``second_bias``, one for each first digit, stands beside ``digit``.
LAYERS = {
    "embedding": (CODES + 1, EMBEDDING),
    "inward": (2 * WINDOW * EMBEDDING + 1, HIDDEN),
    "first": (HIDDEN + 1, DIGIT),
    "digit": (DIGIT, HIDDEN + DIGIT),
    "second": (HIDDEN, DIGIT),
}


def _layers(values: np.ndarray) -> list[np.ndarray]:
    """Views of the layers in a flat array."""
    ends = np.cumsum([rows * columns for rows, columns in LAYERS.values()])
    parts = np.split(values, ends[:-1])
    return [part.reshape(shape) for part, shape in zip(parts, LAYERS.values(), strict=True)]


class Network:
    """The bidirectional window network; its weights are one 32-bit array, and its layers views of it."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.slopes = np.empty_like(values)
        self.slopes_of = _layers(self.slopes)
        self.embedding, self.inward, self.first, self.digit, self.second = _layers(values)
        ones = np.eye(DIGIT, dtype=np.float32)
        self.digits = np.hstack((np.repeat(ones, DIGIT, axis=0), np.tile(ones, (DIGIT, 1))))  # a one at both of a code's

    @classmethod
    def fresh(cls, counts: np.ndarray | None = None, seed: int = 0) -> Network:
        """Random weights; with biases that give each code its share of ``counts``."""
        shares = (np.ones(CODES) if counts is None else counts + 0.5).reshape(DIGIT, DIGIT)
        random = np.random.default_rng(seed)
        made = lambda *shape, scale: random.normal(size=shape) * scale
        context = 2 * WINDOW * EMBEDDING
        layers = [
            made(CODES + 1, EMBEDDING, scale=0.3),
            np.vstack((made(context, HIDDEN, scale=context**-0.5), np.zeros(HIDDEN))),
            np.vstack((made(HIDDEN, DIGIT, scale=0.1), np.log(shares.sum(axis=1) / shares.sum()))),
            np.hstack((made(DIGIT, HIDDEN, scale=0.1), np.log(shares / shares.sum(axis=1, keepdims=True)))),
            made(HIDDEN, DIGIT, scale=0.1),
        ]
        return cls.unflat(np.concatenate([layer.ravel() for layer in layers]))

    def weights(self) -> list[np.ndarray]:
        return [self.values]

    def flat(self) -> np.ndarray:
        return self.values.copy()

    @classmethod
    def unflat(cls, values: np.ndarray) -> Network:
        return cls(np.array(values, dtype=np.float32))

    def _forward(self, context: np.ndarray, first: np.ndarray):
        """Layers of many tokens, a row per token; the last column of ``inputs`` is ones, for the bias."""
        n = len(first)
        inputs = np.empty((n, len(self.inward)), dtype=np.float32)
        inputs[:, -1] = 1
        inputs[:, :-1] = self.embedding.take(context.ravel(), axis=0).reshape(n, -1)
        hidden = inputs @ self.inward
        hidden += hidden
        _tanh_of_exponential(np.exp(hidden, out=hidden))
        return inputs, hidden, *_outward(self, self.biases(), hidden, first)

    def biases(self) -> np.ndarray:
        """Biases of both digits, for each first digit."""
        found = np.empty((DIGIT, 2 * DIGIT), dtype=np.float32)
        found[:, :DIGIT] = self.first[-1]
        found[:, DIGIT:] = self.digit[:, HIDDEN:]
        return found

    def log_probabilities(self, context: np.ndarray, code: np.ndarray) -> np.ndarray:
        return Scorer(self).log_probabilities(context, code)

    def step(self, context: np.ndarray, code: np.ndarray, rate: float, sums: list[np.ndarray]) -> None:
        """One descent step with rates scaled by the squared slopes so far (``sums``)."""
        n = len(code)
        first = code // DIGIT
        inputs, hidden, given, digits, totals = self._forward(context, first)
        digits *= np.reciprocal(totals, out=totals)[:, None]
        digits = digits.reshape(n, -1)
        met = self.digits.take(code, axis=0)
        digits -= met
        one, two = digits[:, :DIGIT], digits[:, DIGIT:]
        back_given = two @ self.second.T
        back_given *= _tanh_slope(given)
        back = one @ self.first[:-1].T
        back += back_given
        back *= _tanh_slope(hidden)
        to_embedding, to_inward, to_first, to_digit, to_second = self.slopes_of
        # input i of a token belongs to number i % EMBEDDING of one of its neighbours
        places = _PLACES.take(context.ravel(), axis=0)
        to_embedding[...] = 0
        np.add.at(to_embedding.ravel(), places.ravel(), (back @ self.inward[:-1].T).ravel())
        np.matmul(inputs.T, back, out=to_inward)
        np.matmul(hidden.T, one, out=to_first[:-1])
        of_first = met[:, :DIGIT].T
        to_biases = of_first @ digits
        to_first[-1] = _DIGIT_ONES @ to_biases[:, :DIGIT]
        to_digit[:, HIDDEN:] = to_biases[:, DIGIT:]
        np.matmul(of_first, back_given, out=to_digit[:, :HIDDEN])
        np.matmul(given.T, two, out=to_second)
        slopes = self.slopes
        slopes *= np.float32(1 / n)  # means over the tokens
        (total,) = sums
        scale = slopes * slopes
        total += scale
        np.sqrt(total, out=scale)
        scale += 1e-6
        slopes /= scale
        slopes *= rate
        self.values -= slopes


class Scorer:
    """A network that is trained no more: what each neighbour adds to the hidden layer is looked up by its code.

    Where no sum of them can leave the range of 32-bit exponentials, these are multiplied instead.
    """

    def __init__(self, network: Network) -> None:
        self.network = network
        self.added = [2 * (network.embedding @ part) for part in np.split(network.inward[:-1], 2 * WINDOW)]
        self.added[0] += 2 * network.inward[-1]
        self.multiplied = sum(np.abs(added).max() for added in self.added) < 80
        if self.multiplied:
            self.added = [np.exp(added) for added in self.added]
        self.biases = network.biases()

    def log_probabilities(self, context: np.ndarray, code: np.ndarray) -> np.ndarray:
        found = np.empty(len(code), dtype=np.float32)
        with np.errstate(over="ignore"):
            for start in range(0, len(code), FORWARD):
                part = slice(start, start + FORWARD)
                self._into(found[part], context[part], code[part])
        return found

    def _into(self, found: np.ndarray, context: np.ndarray, code: np.ndarray) -> None:
        first = code // DIGIT
        hidden = self.added[0].take(context[:, 0], axis=0)
        for i, added in enumerate(self.added[1:], 1):
            join = np.multiply if self.multiplied else np.add
            join(hidden, added.take(context[:, i], axis=0), out=hidden)
        _tanh_of_exponential(hidden if self.multiplied else np.exp(hidden, out=hidden))
        _, digits, sums = _outward(self.network, self.biases, hidden, first)
        shares = digits.ravel().take(_digit_places(code, first)) / sums.reshape(-1, 2).T
        np.log(shares + 1e-12).sum(axis=0, out=found)


#: Where each code's embedding lies in its flat layer, and ones to sum digits with.
_PLACES = np.arange((CODES + 1) * EMBEDDING).reshape(CODES + 1, EMBEDDING)
_DIGIT_ONES = np.ones(DIGIT, dtype=np.float32)


def _outward(network: Network, biases: np.ndarray, hidden: np.ndarray, first: np.ndarray):
    """The layers behind the hidden one: that of the second digit; both digits' shares, two rows a token, not yet
    divided by their sums; and these."""
    n = len(first)
    given = network.digit[:, :HIDDEN].take(first, axis=0)
    given += hidden
    given += given
    _tanh_of_exponential(np.exp(given, out=given))
    digits = np.empty((n, 2 * DIGIT), dtype=np.float32)
    np.matmul(hidden, network.first[:-1], out=digits[:, :DIGIT])
    np.matmul(given, network.second, out=digits[:, DIGIT:])
    digits += biases.take(first, axis=0)
    return given, *_exponentials(digits.reshape(2 * n, DIGIT))


def _tanh_of_exponential(layer: np.ndarray) -> None:
    """Hyperbolic tangents of x in place of exponentials of 2 x: so they take less time than numpy's own."""
    layer += 1
    np.divide(2, layer, out=layer)
    np.subtract(1, layer, out=layer)


def _tanh_slope(layer: np.ndarray) -> np.ndarray:
    slope = layer * layer
    return np.subtract(1, slope, out=slope)


def _exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials, up to a common factor of those that are summed, and their sums over the second axis."""
    found = np.exp(x)
    sums = found @ _DIGIT_ONES if found.ndim == 2 else found.sum(axis=1)
    if not (np.minimum.reduce(sums, axis=None) > 1e-20 and np.maximum.reduce(sums, axis=None) < 1e30):
        found = np.exp(x - x.max(axis=1, keepdims=True))
        sums = found.sum(axis=1)
    return found, sums


def _digit_places(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the first and the second digits of codes lie in the flat shares of both."""
    n = len(code)
    places = np.empty((2, n), dtype=np.int64)
    one, two = places[0], places[1]
    np.add(np.arange(0, 2 * DIGIT * n, 2 * DIGIT), first, out=one)
    # code - DIGIT * first is the second digit, DIGIT further on than the first digits
    np.subtract(code, (DIGIT + 1) * first, out=two)
    two += one
    two += DIGIT
    return places


_OFFSETS = np.array([*range(-WINDOW, 0), *range(1, WINDOW + 1)])
_EDGES = np.full(WINDOW, EDGE, dtype="<u2")


def contexts(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Codes around the positions ``at``: those before, then those after."""
    return contexts_of([codes], [at])[0]


def contexts_of(docs: list[np.ndarray], at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes around the positions ``at`` of each document, those before, then those after; and at them."""
    parts = [_EDGES]
    for codes in docs:
        parts += (codes, _EDGES)
    padded = np.concatenate(parts).astype(np.int64)
    ends = np.cumsum([len(codes) + WINDOW for codes in docs])
    starts = np.concatenate(([0], ends[:-1])) + WINDOW
    places = np.concatenate(at) + np.repeat(starts, [len(positions) for positions in at])
    return padded.take(places[:, None] + _OFFSETS), padded.take(places)


def pieces_of(codes: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """At most ``PIECE`` of a document's positions at a time, with the codes that they and their contexts need."""
    for start in range(0, len(at), PIECE):
        piece = at[start : start + PIECE]
        low = max(piece[0] - WINDOW, 0)
        yield codes[low : piece[-1] + WINDOW + 1], piece - low


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    for batch in sliced(batches, "text", SPLIT_BYTES):
        counts = words_of(batch.column("text"))[0].value_counts()
        yield record_batch(schema, counts.field("values"), counts.field("counts"))


def _code_batches(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[pa.RecordBatch]:
    """Each row numbered, with its codes, its held words' logarithms summed, and its words to be joined."""
    from pyspark import TaskContext

    context = TaskContext.get()
    row = (context.partitionId() if context else 0) << 40
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("codes", pa.binary())]
        + [("logs", pa.float64()), ("rare", pa.list_(pa.binary()))]
    )
    for batch in sliced(batches, "text", SPLIT_BYTES):
        tokens, starts = words_of(batch.column("text"))
        at, away = words.places(tokens)
        size = len(starts) - 1
        codes = pa.Array.from_buffers(
            pa.binary(),
            size,
            [None, pa.py_buffer((2 * starts).astype(np.int32)), pa.py_buffer(words.code[at])],
        )
        logs = np.bincount(np.repeat(np.arange(size), np.diff(starts)), words.log_count[at], size)
        away &= words.joined
        rare_starts = np.concatenate(([0], np.cumsum(away, dtype=np.int32)))[starts]
        rare = pa.ListArray.from_arrays(pa.array(rare_starts, pa.int32()), tokens.filter(pa.array(away)))
        yield record_batch(schema, range(row, row + size), batch.column("doc_id"), codes, logs, rare)
        row += size


def _code_count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("code", pa.int32()), ("n", pa.int64())])
    counts = np.zeros(CODES, dtype=np.int64)
    for batch in batches:
        for blob in batch.column("codes").to_pylist():
            counts += np.bincount(np.frombuffer(blob, dtype="<u2"), minlength=CODES)
    met = np.flatnonzero(counts)
    yield record_batch(schema, met.astype(np.int32), counts[met])


def code_counts(coded: DataFrame) -> np.ndarray:
    """How often each code occurs in (doc_id, codes) rows."""
    counts = np.zeros(CODES)
    met = coded.select("codes").mapInArrow(_code_count_batches, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    for row in met.collect():  # at most one row per code
        counts[row.code] = row.n
    return counts


WEIGHTS = "part int, tokens long, weights binary"
WEIGHT_SCHEMA = pa.schema([("part", pa.int32()), ("tokens", pa.int64()), ("weights", pa.binary())])


def targets(blob: bytes, size: int, round_: int, rounds: int, known: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """Positions of a document masked in a round; each position in one round of them all.

    The first shift follows from the document's codes, so no batch or partition has a say. ``known``
    keeps the positions below ``PIECE`` of each shift for the other documents of the round.
    """
    shift = xxhash.xxh64_intdigest(blob) % MASKED
    at = known.get(shift) if known and size <= PIECE else None
    if at is None:
        wanted = np.flatnonzero((np.arange(MASKED) + shift) % MASKED % rounds == round_)
        keep = known is not None and size <= PIECE
        at = (np.arange(0, PIECE if keep else size, MASKED)[:, None] + wanted).ravel()
        if keep:
            known[shift] = at
    return at[: at.searchsorted(size)]


def _train_batches(
    batches: Iterator[pa.RecordBatch], start: bytes, round_: int, rounds: int
) -> Iterator[pa.RecordBatch]:
    """This task's weights after its masked tokens of all its documents."""
    from pyspark import TaskContext

    context = TaskContext.get()
    part = context.partitionId() if context else 0
    network = Network.unflat(np.frombuffer(start, dtype=np.float32).copy())
    sums = [np.full_like(w, 0.1) for w in network.weights()]
    seen = 0
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    known: dict[int, np.ndarray] = {}

    def learn():
        nonlocal seen, waiting
        around, codes = contexts_of(*zip(*held, strict=True))
        order = np.random.default_rng(seen).permutation(len(codes))
        around, codes = around.take(order, axis=0), codes.take(order)
        with np.errstate(over="ignore"):
            for at in range(0, len(codes), MINIBATCH):
                rows = slice(at, at + MINIBATCH)
                network.step(around[rows], codes[rows], RATE, sums)
        seen += len(codes)
        held.clear()
        waiting = 0

    for batch in batches:
        for blob in batch.column("codes").to_pylist():
            codes = np.frombuffer(blob, dtype="<u2")
            for piece in pieces_of(codes, targets(blob, len(codes), round_, rounds, known)):
                held.append(piece)
                waiting += len(piece[1])
                if waiting >= PIECE:
                    learn()
    if waiting:
        learn()
    yield record_batch(WEIGHT_SCHEMA, [part % AVERAGED], [seen], [network.flat().tobytes()])


def _mean_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, tokens = None, 0
    for batch in batches:
        for n, blob in zip(batch.column("tokens").to_pylist(), batch.column("weights").to_pylist(), strict=True):
            weighted = np.frombuffer(blob, dtype=np.float32).astype(np.float64) * n
            total = weighted if total is None else total + weighted
            tokens += n
    if tokens:
        yield record_batch(WEIGHT_SCHEMA, [0], [tokens], [(total / tokens).astype(np.float32).tobytes()])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of every distinct word of all documents, stored."""
    return stored(
        docs.mapInArrow(_count_batches, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )


def vocabulary(counts: DataFrame) -> Words:
    """The words that tasks hold: the most frequent, ties by the word, have codes of their own."""
    ranked = counts.withColumn("rank", F.floor(8 * F.log2("n")).cast("int"))
    sizes = ranked.groupBy("rank").agg(F.sum(F.length("word") + 64).alias("bytes")).collect()  # ranks, not words
    taken = 0
    least = None
    for rank, size in sorted(sizes, reverse=True):
        taken += size
        if taken > HELD_BYTES:
            break
        least = rank
    held: list[tuple[bytes, int]] = []
    if least is not None:
        found = ranked.where(F.col("rank") >= least).select("word", "n").toArrow()
        held = [*zip(found.column("word").to_pylist(), found.column("n").to_pylist(), strict=True)]
    if len(held) < CODES - OTHER:  # the most frequent may lie behind them
        top = counts.orderBy(F.desc("n"), "word").limit(CODES - OTHER).collect()
        most = [(bytes(row.word), row.n) for row in top]
    else:
        most = heapq.nsmallest(CODES - OTHER, held, key=lambda entry: (-entry[1], entry[0]))
    own = [word for word, _ in most]
    known = set(own)
    others = [(word, n) for word, n in held if word not in known]
    hashes = np.array([xxhash.xxh64_intdigest(word) % OTHER for word, _ in others], dtype=np.int64)
    shared = CODES - OTHER + np.concatenate((hashes, np.arange(OTHER)))
    logs = np.log(np.array([n for _, n in others], dtype=np.float64))
    return Words(
        pa.array(own + [word for word, _ in others], pa.binary()),
        np.concatenate((np.arange(len(own)), shared)).astype("<u2"),
        np.concatenate((np.zeros(len(own)), logs, np.zeros(OTHER))),
        # the logarithm of a word met once is 0
        any(rank > 0 and (least is None or rank < least) for rank, _ in sizes),
    )


def trained(coded: DataFrame, rounds: int = ROUNDS, counts: np.ndarray | None = None) -> Network:
    """A network trained on (doc_id, codes) rows; without any token, the one it starts from."""
    network = Network.fresh(code_counts(coded) if counts is None else counts)
    for round_ in range(rounds):
        parts = (
            coded.select("codes")
            .mapInArrow(partial(_train_batches, start=network.flat().tobytes(), round_=round_, rounds=rounds), WEIGHTS)
            .repartition(AVERAGED, "part")
            .mapInArrow(_mean_batches, WEIGHTS)
            .collect()  # one row per group of tasks
        )
        tokens = sum(row.tokens for row in parts)
        if not tokens:
            continue
        means = (np.frombuffer(row.weights, dtype=np.float32).astype(np.float64) * row.tokens for row in parts)
        network = Network.unflat(sum(means) / tokens)
    return network


def document_score(network: Network | Scorer, codes: np.ndarray) -> float:
    """The summed conditional log-probabilities of a document's tokens."""
    return float(
        sum(
            network.log_probabilities(*contexts_of([part], [at])).sum(dtype=np.float64)
            for part, at in pieces_of(codes, np.arange(len(codes)))
        )
    )


def _score_batches(
    batches: Iterator[pa.RecordBatch], network: bytes, log_counts: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """``log_counts`` of the shared codes; 0 for those that are one word's own."""
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("log_likelihood", pa.float64())]
    )
    model = Scorer(Network.unflat(np.frombuffer(network, dtype=np.float32)))
    for batch in batches:
        for start in range(0, batch.num_rows, 64):  # small documents share a pass through the network
            part = batch.slice(start, 64)
            docs = [np.frombuffer(b, dtype="<u2") for b in part.column("codes").to_pylist()]
            sizes = np.array([len(d) for d in docs])
            totals = np.zeros(len(docs))
            small = [i for i, d in enumerate(docs) if len(d) <= PIECE]
            group: list[int] = []
            held = 0
            for i in [*small, None]:
                if i is None or held + len(docs[i]) > PIECE:
                    if held:
                        around, codes = contexts_of([docs[j] for j in group], [np.arange(sizes[j]) for j in group])
                        logs = model.log_probabilities(around, codes) - log_counts[codes]
                        owner = np.repeat(np.arange(len(group)), sizes[group])
                        totals[group] = np.bincount(owner, logs, len(group))
                    group, held = [], 0
                if i is not None:
                    group.append(i)
                    held += len(docs[i])
            for i, codes in enumerate(docs):
                if len(codes) > PIECE:
                    totals[i] = document_score(model, codes) - log_counts[codes].sum()
            totals += part.column("logs").to_numpy()
            yield record_batch(schema, part.column("row"), part.column("doc_id"), sizes, totals)


def scored(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of every row, by a network of its own table.

    Defined cases: a null or wordless text has no tokens, a sum of 0 and a null mean; null
    and repeated ids keep their own rows; other columns of ``docs`` are not looked at.
    """
    rows = docs.select(docs[id].cast("long").alias("doc_id"), text_of(docs, text).alias("text"))
    words = word_counts(rows.select("text"))
    held = vocabulary(words)
    coded = stored(
        rows.mapInArrow(
            partial(_code_batches, words=held),
            "row long, doc_id long, codes binary, logs double, rare array<binary>",
        ),
        "codes",
    )
    counts = code_counts(coded)
    network = trained(coded, counts=counts).flat().tobytes()
    log_counts = np.log(np.maximum(counts, 1))
    log_counts[: CODES - OTHER] = 0
    found = coded.select("row", "doc_id", "codes", "logs").mapInArrow(
        partial(_score_batches, network=network, log_counts=log_counts),
        "row long, doc_id long, n_tokens long, log_likelihood double",
    )
    if held.joined:
        rare = (
            coded.select("row", F.explode("rare").alias("word"))
            .join(words.where("n > 1"), "word")
            .groupBy("row")
            .agg(F.sum(F.log("n")).alias("more"))
        )
        found = found.join(rare, "row", "left").withColumn(
            "log_likelihood", F.col("log_likelihood") + F.coalesce("more", F.lit(0.0))
        )
    return found.select("doc_id", "n_tokens", "log_likelihood").withColumn(
        "mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    )
