"""Phrase collocations by prefix-free parsing of the corpus.

Texts are parsed into chunks that begin at content triggers: a word whose hash is divisible by
``TRIGGER`` opens a chunk wherever it stands, so equal passages fall into equal chunks. The parse is a
dictionary of distinct chunks, each with the number of times it occurs. A chunk reaches over
the start of the next one by as many words as a phrase needs; a phrase occurrence belongs to the
chunk in whose own part it starts, so overlaps are assigned once. Phrases are then counted inside
the distinct chunks, weighted by the chunk's frequency, and a passage copied a thousand
times is counted once.

Two passes over the dictionary count them. The first counts two-word phrases by a 64-bit hash. Those
that may reach the minimum count go into a bit table of fixed size. The second pass counts exact
strings: of single words, of two-word phrases in the table, and of longer ones whose
two-word parts all are in it. A collision in either only lets more strings through, so
counts are exact. Within a task words have numbers of their own, so no hash decides equality.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import record_batch, sliced, stored, text_of

#: One word in so many opens a chunk; a chunk without any ends after CHUNK_WORDS tokens.
TRIGGER = 32
CHUNK_WORDS = 512

#: Most words of a phrase.
LONGEST = 3

#: Fixed values of the report: least count, share of a longer phrase that absorbs, rows per language.
LEAST = 10
ABSORBED = 50
REPORTED = 2000

#: Language of rows that name none.
NO_LANG = "und"

#: Tokens counted at a time in a task, and words it numbers before it starts anew.
BLOCK = 1 << 20
NUMBERED = (1 << 21) - BLOCK - 2 * CHUNK_WORDS

#: Bits of the table of two-word phrases that may be frequent: 8 MB for each task, whatever the input.
TABLE_BITS = 1 << 26

#: Parts a language's candidates are ranked in before its first rows are.
RANKED_PARTS = 64

_TOKENS = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]+")
_BREAKS = frozenset(b".,;:!?\n\x0b\x0c\r")
BREAK = "\n"


class _Openers(dict):
    """Whether a token opens a chunk: 1, is an ordinary word: 0, or breaks a piece: -1."""

    def __missing__(self, token: bytes) -> int:
        kind = -1 if token[0] in _BREAKS else int(xxhash.xxh64_intdigest(token) % TRIGGER == 0)
        if len(self) < 200_000 and len(token) <= 64:
            self[token] = kind
        return kind


def chunks(text: str, openers: dict[bytes, int] | None = None) -> Iterator[tuple[int, str]]:
    """(own tokens, chunk): words joined by spaces, a break between pieces as a token of its own.

    What follows a chunk's own tokens are the next words of the same piece, one less than
    a phrase has at most.
    """
    openers = _Openers() if openers is None else openers
    tokens = _TOKENS.findall(text.encode().lower())
    kinds = [openers[token] for token in tokens]
    cuts = [0]
    for at, kind in enumerate(kinds):
        if at > cuts[-1] and (kind == 1 or at - cuts[-1] == CHUNK_WORDS):
            cuts.append(at)
    if -1 in kinds:
        tokens = [b"\n" if kind < 0 else token for token, kind in zip(tokens, kinds, strict=True)]
    cuts.append(len(tokens))
    for start, end in zip(cuts, cuts[1:], strict=False):
        if start == end:
            continue
        reach = end
        while reach < len(tokens) and reach - end < LONGEST - 1 and kinds[reach] >= 0 and kinds[end - 1] >= 0:
            reach += 1
        yield end - start, b" ".join(tokens[start:reach]).decode()


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("own", pa.int32()), ("chunk", pa.string())])
    openers = _Openers()
    for batch in sliced(batches, "text", 1 << 22):
        langs, owns, found = [], [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for own, chunk in chunks(text, openers):
                langs.append(lang)
                owns.append(own)
                found.append(chunk)
        yield record_batch(schema, langs, owns, found)


def parsed(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The dictionary: (lang, own, chunk, n), each distinct chunk of a language once."""
    rows = docs.select(F.coalesce(docs[lang].cast("string"), F.lit(NO_LANG)).alias("lang"), text_of(docs, text).alias("text"))
    found = rows.mapInArrow(_chunk_batches, "lang string, own int, chunk string")
    return stored(found.groupBy("lang", "own", "chunk").agg(F.count(F.lit(1)).alias("n")), "chunks")


class _Numbers(dict):
    """Words of one language to numbers, which all languages of a task draw from one row."""

    def __init__(self, lang: str, words: list[str], langs: list[str]) -> None:
        super().__init__({BREAK: 0})
        self.lang, self.words, self.langs = lang, words, langs

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return number


class Block:
    """Tokens of many chunks as numbers, 0 where no phrase passes."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        """Drop the numbering of words, which must not pass 21 bits."""
        self.words, self.langs = [""], [""]
        self.by_lang: dict[str, _Numbers] = {}
        self.hashes = np.zeros(1, dtype=np.uint64)
        self.clear()

    def clear(self) -> None:
        self.tokens: list[int] = []
        self.sizes: list[int] = []
        self.owns: list[int] = []
        self.weights: list[int] = []

    def add(self, lang: str, own: int, chunk: str, n: int) -> None:
        numbers = self.by_lang.get(lang)
        if numbers is None:
            numbers = self.by_lang[lang] = _Numbers(lang, self.words, self.langs)
        before = len(self.tokens)
        self.tokens.extend(map(numbers.__getitem__, chunk.split(" ")))
        self.tokens.append(0)
        self.sizes.append(len(self.tokens) - before)
        self.owns.append(own)
        self.weights.append(n)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, weights, and whether a phrase may start at each place."""
        tokens, sizes = np.array(self.tokens, dtype=np.int64), np.array(self.sizes)
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        starts = (place < np.repeat(np.array(self.owns), sizes)) & (tokens > 0)
        return tokens, np.repeat(np.array(self.weights, dtype=np.int64), sizes), starts

    def pair_hashes(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """A hash of two numbered words and their language, alike in every task."""
        fresh = range(len(self.hashes), len(self.words))
        if fresh:
            made = [xxhash.xxh64_intdigest(self.words[i], xxhash.xxh32_intdigest(self.langs[i])) for i in fresh]
            self.hashes = np.concatenate((self.hashes, np.array(made, dtype=np.uint64)))
        mixed = self.hashes[first] * np.uint64(0x9E3779B97F4A7C15)  # an odd constant: the order of the words counts
        mixed ^= mixed >> np.uint64(29)
        mixed += self.hashes[second]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ (mixed >> np.uint64(32))


def _counted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sum of each one's weights, and each row's place among them."""
    distinct, place = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(sums, place, weights)
    return distinct, sums, place


def _blocks(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[None]:
    """Fills the block again and again from (lang, own, chunk, n) rows."""
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("lang", "own", "chunk", "n"))
        for row in zip(*columns, strict=True):
            block.add(*row)
            if len(block.tokens) >= BLOCK:
                yield
                block.clear()
                if len(block.words) >= NUMBERED:
                    block.forget()
    if block.tokens:
        yield


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("hash", pa.int64()), ("n", pa.int64())])
    block = Block()
    for _ in _blocks(batches, block):
        tokens, weights, starts = block.arrays()
        at = np.flatnonzero(starts[:-1] & (tokens[1:] > 0))
        keys, sums, _ = _counted(tokens[at] << 21 | tokens[at + 1], weights[at])
        hashes = block.pair_hashes(keys >> 21, keys & (1 << 21) - 1)
        yield record_batch(schema, hashes.view(np.int64), sums)


def _phrase_batches(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
    low = (1 << 21) - 1
    block = Block()
    for _ in _blocks(batches, block):
        tokens, weights, starts = block.arrays()
        words, langs = block.words, block.langs

        def rows(size: int, keys: np.ndarray, sums: np.ndarray, words=words, langs=langs) -> pa.RecordBatch:
            parts = [(keys >> 21 * (size - 1 - i) & low).tolist() for i in range(size)]
            phrases = [" ".join([words[i] for i in group]) for group in zip(*parts, strict=True)]
            return record_batch(schema, [langs[i] for i in parts[0]], [size] * len(keys), phrases, sums)

        at = np.flatnonzero(starts)
        keys, sums, _ = _counted(tokens[at], weights[at])
        yield rows(1, keys, sums)
        # pairs at every place, also where only a longer phrase's second pair may start
        at = np.flatnonzero((tokens[:-1] > 0) & (tokens[1:] > 0))
        keys, sums, place = _counted(tokens[at] << 21 | tokens[at + 1], weights[at] * starts[at])
        hashes = block.pair_hashes(keys >> 21, keys & low)
        slots = hashes & np.uint64(TABLE_BITS - 1)
        known = (table[slots >> np.uint64(6)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)
        kept = known & (sums > 0)
        yield rows(2, keys[kept], sums[kept])
        pairs = np.zeros(len(tokens) + 1, dtype=bool)
        pairs[at] = known[place]
        at = np.flatnonzero(pairs[:-1] & pairs[1:] & starts)
        keys, sums, _ = _counted(tokens[at] << 42 | tokens[at + 1] << 21 | tokens[at + 2], weights[at])
        yield rows(3, keys, sums)


def _pair_table(dictionary: DataFrame, least: int) -> np.ndarray:
    """Bits of the two-word phrases whose hashes occur ``least`` times; TABLE_BITS / 64 numbers at most."""
    hashes = dictionary.mapInArrow(_pair_batches, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    slot = F.col("hash").bitwiseAND(TABLE_BITS - 1)
    bits = (
        hashes.where(F.col("n") >= least)
        .groupBy(F.shiftright(slot, 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(hash & 63 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(TABLE_BITS // 64, dtype=np.uint64)
    table[bits.column("at").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return table


def phrase_counts(dictionary: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, size, phrase, n): every word, and the longer phrases that occur ``least`` times."""
    table = _pair_table(dictionary, least)
    found = dictionary.mapInArrow(
        partial(_phrase_batches, table=table), "lang string, size int, phrase string, n long"
    )
    counts = found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return stored(counts.where((F.col("size") == 1) | (F.col("n") >= least)), "phrases")


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(18,0)")


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Each candidate with its lowest-scoring cut: k, l, r and score."""
    words = F.split("phrase", " ")
    known = counts.select(F.col("lang"), F.col("phrase").alias("part"), F.col("n").alias("found"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).withColumns(
        {
            "left": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
            "right": F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "),
        }
    )
    both = (
        cuts.join(known.withColumnsRenamed({"part": "left", "found": "l"}), ["lang", "left"])
        .join(known.withColumnsRenamed({"part": "right", "found": "r"}), ["lang", "right"])
        .withColumns({"a2": (_wide("a") * _wide("a")).cast("decimal(32,0)"), "lr": _wide("l") * _wide("r")})
        .withColumn("score", F.expr("cast(a2 * 1000000BD AS decimal(38,0)) div lr"))
    )
    return both.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "cut.l", "cut.r", "cut.score"
    )


def _absorbed(candidates: DataFrame) -> DataFrame:
    """Candidates contained in a longer one that has the share ``ABSORBED`` of their count."""
    words = F.split("phrase", " ")
    inner = candidates.where("size > 2").select(
        "lang",
        F.col("a").alias("longer"),
        F.explode(F.array(*(F.array_join(F.slice(words, i, 2), " ") for i in range(1, LONGEST)))).alias("phrase"),
    )
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return candidates.join(most, ["lang", "phrase"]).where(
        100 * F.col("longer") >= ABSORBED * F.col("a")
    ).select("lang", "phrase")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words by language.

    ``a`` counts the phrase, ``l`` and ``r`` the parts at its lowest-scoring cut, ``n`` all words of
    the language; the score is floor(1000000 a a / (l r)). Defined cases: null texts are empty, a null
    language is ``und``; repeated rows count as often as they occur; ties of score and
    count go by the phrase's bytes; languages without a candidate have no row; other columns of
    ``docs`` are not looked at.
    """
    counts = phrase_counts(parsed(docs, text, lang))
    totals = counts.where("size = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = counts.where("size > 1").withColumnRenamed("n", "a")
    kept = (
        _scored(candidates, counts)
        .join(_absorbed(candidates), ["lang", "phrase"], "left_anti")
        .join(candidates.select("lang", "phrase", "a"), ["lang", "phrase"])
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS))
    best = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(
        F.col("rank") <= REPORTED
    )
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (
        ranked.where(F.col("rank") <= REPORTED)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
