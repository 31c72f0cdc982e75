"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

The trees are fitted with numpy on at most ``FIT_ROWS`` labelled rows; the lexicon behind
the features comes from the same rows. To keep the features honest, rows are described by the
lexicon of the other half while fitting. Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import record_batch, sliced, stored, text_of

#: Labelled rows that the model is fitted on at most, those with the smallest hashes of their id.
FIT_ROWS = 20_000

#: Lexicon terms at most, and the evidence each needs: toxic rows, and standard deviations.
TERMS = 1_000
TERM_ROWS = 4
TERM_DEVIATIONS = 5.5

#: Characters described at a time.
PIECE = 1 << 20

#: Leading letters of a word that count as its stem.
STEM = 6

#: Fixed value: second-person words.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer sie ihnen tu te toi ton ta tes "
    "vous votre vos tú ti tuyo usted ustedes vosotros os".split()
)

#: Fixed value: letters behind the signs and digits that stand in for them.
STAND_INS = str.maketrans("013457@$!", "oieastasi")

WORD = re.compile(r"[^\W\d_]+")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~]")
# possessive, and only from a word's first letter, so that a plain word is passed over in one go
DISGUISED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[0-9@$!*.\-_]{1,2}[^\W\d_]++)+|[@$][^\W\d_]{2,}")
SPACED = re.compile(r"\b(?:[^\W\d_][ .\-_*]){3,}[^\W\d_]\b")
STRETCHED = re.compile(r"([^\W\d_])\1{2,}")

FEATURES = (
    "words",
    "hits",
    "hit_density",
    "distinct_hits",
    "stem_hits",
    "stem_density",
    "strongest",
    "strength",
    "second_person_density",
    "nearest_second_person",
    "hits_near_second_person",
    "capitals",
    "loud_words",
    "punctuation",
    "exclamations",
    "questions",
    "disguised",
    "disguised_hits",
    "spaced",
    "stretched",
    "densest_part",
)


def _plain(disguised: str) -> str:
    return re.sub(r"[^a-zß-ÿ]", "", disguised.lower().translate(STAND_INS))


def _pieces(text: str) -> Iterator[str]:
    """The text cut at white space into pieces of bounded length."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = cut + 1 if cut > at else end
        yield text[at:end]
        at = end


def terms(text: str) -> set[str]:
    """Words, and word stems with a leading ``^``, that a text has."""
    found: set[str] = set()
    for piece in _pieces(text):
        words = set(WORD.findall(piece.lower()))
        words.update(_plain(match.group()) for match in DISGUISED.finditer(piece))
        found |= words
        found.update("^" + word[:STEM] for word in words if len(word) > STEM)
    found.discard("")
    return found


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """The dense description of a whole text; a text without words gives zeros."""
    whole = {term: weight for term, weight in lexicon.items() if term[0] != "^"}
    stems = {term[1:]: weight for term, weight in lexicon.items() if term[0] == "^"}
    telling = SECOND_PERSON.union(whole)
    count = upper = letters = loud = marks = shouts = asks = disguised = spaced = stretched = 0
    hits: list[int] = []
    stem_hits: list[int] = []
    persons: list[int] = []
    seen: Counter[str] = Counter()
    hidden = 0
    for piece in _pieces(text):
        words = WORD.findall(lowered := piece.lower())
        for at, word in [(n, w) for n, w in enumerate(words, count) if w in telling or w[:STEM] in stems]:
            if word in whole:
                hits.append(at)
                seen[word] += 1
            elif word[:STEM] in stems and len(word) > STEM:
                stem_hits.append(at)
                seen["^" + word[:STEM]] += 1
            if word in SECOND_PERSON:
                persons.append(at)
        count += len(words)
        letters += sum(map(len, words))
        runs = UPPER.findall(piece)
        upper += sum(map(len, runs))
        loud += sum(len(run) > 2 for run in runs)
        marks += len(PUNCTUATION.findall(piece))
        shouts += piece.count("!")
        asks += piece.count("?")
        odd = " ".join([token for token in piece.split() if not token.isalpha()])
        for match in DISGUISED.finditer(odd):
            disguised += 1
            plain = _plain(match.group())
            hidden += plain in whole and match.group().lower() != plain
        spaced += sum(1 for _ in SPACED.finditer(piece))
        stretched += sum(1 for _ in STRETCHED.finditer(lowered))
    if not count:
        return [0.0] * len(FEATURES)
    places = np.sort(np.array(hits + stem_hits, dtype=np.int64))
    near, nearest, densest = 0, 0.0, 0
    if len(places):
        densest = int((np.searchsorted(places, places + 50) - np.arange(len(places))).max())
        if persons:
            others = np.array(persons)
            right = np.searchsorted(others, places)
            gaps = np.minimum(
                np.abs(others[np.minimum(right, len(others) - 1)] - places),
                np.abs(places - others[np.maximum(right - 1, 0)]),
            )
            near, nearest = int((gaps <= 5).sum()), 1.0 / (1.0 + float(gaps.min()))
    strengths = [lexicon[term] for term in seen]
    return [
        float(np.log1p(count)),
        float(np.log1p(len(hits))),
        len(hits) / count,
        float(sum(term[0] != "^" for term in seen)),
        float(np.log1p(len(stem_hits))),
        len(stem_hits) / count,
        max(strengths, default=0.0),
        float(sum(lexicon[term] * number for term, number in seen.items())) / count,
        len(persons) / count,
        nearest,
        float(np.log1p(near)),
        upper / max(letters, 1),
        loud / count,
        marks / count,
        shouts / count,
        asks / count,
        disguised / count,
        float(np.log1p(hidden)),
        spaced / count,
        stretched / count,
        float(densest),
    ]


@dataclass
class Trees:
    """Boosted regression trees on binned features, all of one depth."""

    depth: int = 3
    rounds: int = 60
    rate: float = 0.2
    leaf_weight: float = 2.0
    penalty: float = 1.0
    bins: int = 32
    cuts: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        shares = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.cuts = [np.unique(np.concatenate((np.quantile(c, shares), [0.0]))) for c in x.T]
        binned = self._binned(x)
        width = max(len(c) for c in self.cuts) + 1
        offsets = np.arange(x.shape[1]) * width
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        margin = np.full(len(y), self.base)
        for _ in range(self.rounds):
            chance = 1 / (1 + np.exp(-margin))
            slope, bend = chance - y, chance * (1 - chance)
            tree = self._grow(binned, slope, bend, offsets, width)
            self.trees.append(tree)
            margin += self._leaves(tree, binned)
        return self

    def _grow(self, binned, slope, bend, offsets, width):
        inner = 2**self.depth - 1
        split_on, split_at = np.zeros(inner, dtype=np.int64), np.full(inner, width, dtype=np.int64)
        node = np.zeros(len(slope), dtype=np.int64)
        cells = binned + offsets
        size = width * binned.shape[1]
        for level in range(self.depth):
            first = 2**level - 1
            nodes = 2**level
            flat = (cells + ((node - first) * size)[:, None]).ravel()
            shape = (nodes, binned.shape[1], width)
            repeat = binned.shape[1]
            g = np.bincount(flat, np.repeat(slope, repeat), nodes * size).reshape(shape).cumsum(axis=2)
            h = np.bincount(flat, np.repeat(bend, repeat), nodes * size).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[..., -1:], h[..., -1:]
            gain = (
                g**2 / (h + self.penalty)
                + (all_g - g) ** 2 / (all_h - h + self.penalty)
                - all_g**2 / (all_h + self.penalty)
            )
            gain[(h < self.leaf_weight) | (all_h - h < self.leaf_weight)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            useful = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            split_on[first : first + nodes] = np.where(useful, best // width, 0)
            split_at[first : first + nodes] = np.where(useful, best % width, width)
            rows = np.arange(len(node))
            node = 2 * node + 1 + (binned[rows, split_on[node]] > split_at[node])
        leaf = node - inner
        g = np.bincount(leaf, slope, inner + 1)
        h = np.bincount(leaf, bend, inner + 1)
        return split_on, split_at, -self.rate * g / (h + self.penalty)

    def _leaves(self, tree, binned: np.ndarray) -> np.ndarray:
        split_on, split_at, values = tree
        node = np.zeros(len(binned), dtype=np.int64)
        rows = np.arange(len(binned))
        for _ in range(self.depth):
            node = 2 * node + 1 + (binned[rows, split_on[node]] > split_at[node])
        return values[node - len(split_on)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        return self.base + sum((self._leaves(tree, binned) for tree in self.trees), np.zeros(len(x)))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing curve closest to y over x, by pooling adjacent violators."""
    blocks: list[list[float]] = []  # sum of x, sum of y, weight
    for a, b in zip(*(v[np.argsort(x, kind="stable")] for v in (x, y)), strict=True):
        blocks.append([float(a), float(b), 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return (
        np.array([s / w for s, _, w in blocks]),
        np.array([(s + 0.05) / (w + 0.1) for _, s, w in blocks]),  # never quite 0 or 1
    )


@dataclass
class Model:
    """A fitted scorer; without both classes among the labels it gives their constant share."""

    lexicon: dict[str, float] = field(default_factory=dict)
    trees: Trees | None = None
    curve: tuple[np.ndarray, np.ndarray] | None = None
    constant: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.full(len(x), self.constant)
        return np.interp(self.trees.margin(x), *self.curve)


def is_held_out(id: Column) -> Column:
    """Rows never used for fitting; a row without id is one of them."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit(""))) % 5 == 0


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("term", pa.string())] + [(n, pa.int64()) for n in ("even0", "even1", "odd0", "odd1")])
    for batch in sliced(batches, "text", 1 << 24):
        counts: Counter[tuple[str, int]] = Counter()
        columns = (batch.column(name).to_pylist() for name in ("text", "half", "toxic"))
        for text, half, toxic in zip(*columns, strict=True):
            counts.update((term, 2 * half + toxic) for term in terms(text))
        names = sorted({term for term, _ in counts})
        yield record_batch(schema, names, *([counts[term, cell] for term in names] for cell in range(4)))


def _feature_batches(batches: Iterator[pa.RecordBatch], lexicons: list[dict]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("half", pa.int32()), ("toxic", pa.int32()), ("x", pa.list_(pa.float64()))]
    )
    for batch in sliced(batches, "text", 1 << 24):
        halves = batch.column("half").to_pylist()
        texts = batch.column("text").to_pylist()
        x = [features(text, lexicons[half]) for text, half in zip(texts, halves, strict=True)]
        yield record_batch(
            schema, batch.column("doc_id"), batch.column("half"), batch.column("toxic"), x
        )


def _lexicon(counts: np.ndarray, names: list[str], toxic: float, clean: float) -> dict[str, float]:
    """Terms clearly more frequent in toxic rows, with their log odds; counts has (clean, toxic)."""
    share = toxic / max(toxic + clean, 1)
    seen = counts.sum(axis=1)
    sure = (counts[:, 1] - seen * share) / np.sqrt(np.maximum(seen * share * (1 - share), 1e-9))
    odds = np.log((counts[:, 1] + 0.5) / (toxic + 1)) - np.log((counts[:, 0] + 0.5) / (clean + 1))
    good = (counts[:, 1] >= TERM_ROWS) & (sure >= TERM_DEVIATIONS)
    order = np.lexsort((np.array(names, dtype=object), -sure))
    return {names[i]: float(odds[i]) for i in order if good[i]}


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model from at most ``rows`` labelled rows outside the held-out fifth.

    ``docs`` has (doc_id, text), ``labels`` (doc_id, toxic); a document with several labels
    is toxic if one says so, rows with a null id or label are left out.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)  # the bound of the broadcast
    )
    sample = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs, "text").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .withColumn("half", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)).cast("int")),
        "labelled",
    )
    sizes = {(r.half, r.toxic): r["count"] for r in sample.groupBy("half", "toxic").count().collect()}
    toxic, clean = (sum(n for (_, t), n in sizes.items() if t == want) for want in (1, 0))
    if not toxic or not clean:
        return Model(constant=toxic / max(toxic + clean, 1))
    share = toxic / (toxic + clean)
    cells = ("even0", "even1", "odd0", "odd1")
    seen = F.col("even0") + F.col("even1") + F.col("odd0") + F.col("odd1")
    hot = F.col("even1") + F.col("odd1")
    strongest = (
        sample.select("text", "half", "toxic")
        .mapInArrow(_term_batches, "term string, " + ", ".join(f"{n} long" for n in cells))
        .groupBy("term")
        .agg(*(F.sum(n).alias(n) for n in cells))
        .where(hot >= TERM_ROWS)
        .orderBy(F.desc((hot - seen * share) / F.sqrt(seen)), "term")
        .limit(TERMS)
        .collect()
    )
    names = [row.term for row in strongest]
    counts = np.array([[row[n] for n in cells] for row in strongest], dtype=float).reshape(-1, 4)
    halves = [
        _lexicon(
            counts[:, [2, 3] if half == 0 else [0, 1]], names, sizes.get((1 - half, 1), 0), sizes.get((1 - half, 0), 0)
        )
        for half in (0, 1)  # each half is described by the other's terms
    ]
    lexicon = _lexicon(counts[:, :2] + counts[:, 2:], names, toxic, clean)
    described = (
        sample.mapInArrow(
            partial(_feature_batches, lexicons=halves), "doc_id long, half int, toxic int, x array<double>"
        )
        .toPandas()
        .sort_values("doc_id")
    )
    x = np.array(described.x.tolist(), dtype=float)
    y = described.toxic.to_numpy(dtype=float)
    # five folds: margins for the calibration come from trees that have not seen the row
    fold = np.arange(len(y)) % 5
    margins = np.zeros(len(y))
    for part in range(5):
        if (fold != part).any() and (fold == part).any():
            margins[fold == part] = Trees().fit(x[fold != part], y[fold != part]).margin(x[fold == part])
    return Model(lexicon, Trees().fit(x, y), isotonic(margins, y))


def _score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    for batch in sliced(batches, "text", 1 << 24):
        x = np.array([features(text, model.lexicon) for text in batch.column("text").to_pylist()])
        yield record_batch(schema, batch.column("doc_id"), model.scores(x))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Defined cases: a null or wordless text is scored by features that are all zero; null and
    repeated ids keep their own rows; other columns of ``docs`` are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs, "text").alias("text"))
    return rows.mapInArrow(partial(_score_batches, model=model), "doc_id long, score double").select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _clean_batches(batches: Iterator[pa.RecordBatch], model: Model, column: str) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, column, 1 << 24):
        x = np.array([features(text or "", model.lexicon) for text in batch.column(column).to_pylist()])
        yield batch.filter(pa.array(model.scores(x) < 0.5))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that are not predicted to be toxic."""
    model = fit(docs, labels)
    return docs.mapInArrow(partial(_clean_batches, model=model, column="text"), docs.schema)
