"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

Merges are applied inside pre-tokens only. Within one, a token is final once the bytes that follow
reach beyond the merge list's lookahead: merges act left of where two continuations differ only
through a chain of merges of falling priority, each beginning inside the part the next one needs.
``lookahead`` is the length of the longest such chain, computed from the merge list. So a pre-token
of any length passes through a buffer of fixed size. Decoding is a byte-to-text state machine that
holds at most one incomplete character.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ticklake.llm.common import record_batch, sliced, text_of, worker_memory

#: Fixed value: the split pattern of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The same for texts below U+0250, whose letters and digits can be listed; twice as fast.
LATIN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zªµºÀ-ÖØ-öø-\u024f]+| ?[0-9²³¹¼½¾]+"
    r"| ?[^\t-\r \x85\xa0A-Za-zªµºÀ-ÖØ-öø-\u024f0-9²³¹¼½¾]+|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+"
)

#: Characters split into pre-tokens at a time, and the longest pre-token handled whole.
PIECE = 1 << 16
WHOLE = 1 << 10

#: Pre-tokens whose tokens are remembered at most, the half used last.
REMEMBERED = 500_000

#: No merge.
NEVER = 1 << 30


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file.

    Printable Latin-1 characters stand for themselves, the others for letters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in plain}
    for byte in range(256):
        letters.setdefault(byte, chr(0x100 + sum(b not in plain for b in range(byte))))
    return [letters[byte] for byte in range(256)]


class Vocabulary:
    """Tokens, merges and special tokens read from a tokenizer file."""

    def __init__(self, definition: str) -> None:
        file = json.loads(definition)
        letters = {letter: byte for byte, letter in enumerate(byte_letters())}
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.ids = {as_bytes(token): number for token, number in file["model"]["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        self.merges = [(as_bytes(a), as_bytes(b)) for a, b in pairs]
        self.specials = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.ranks = {(self.ids[a] << 20) + self.ids[b]: rank for rank, (a, b) in enumerate(self.merges)}
        self.products = [self.ids[a + b] for a, b in self.merges]
        self.single = [self.ids[bytes([byte])] for byte in range(256)]
        contents = {number: token for token, number in self.ids.items()}
        contents |= {number: text.encode() for text, number in self.specials.items()}
        self.contents = [contents.get(n, b"") for n in range(max(contents) + 1)]
        self.special_pattern = regex.compile(
            "|".join(sorted(map(regex.escape, self.specials), key=len, reverse=True)) or r"(?!)"
        )

    @cached_property
    def lookahead(self) -> int:
        """Bytes that have to follow a token before it is final.

        ``reach[x]`` is the longest chain among the merges read so far that take token ``x`` as
        their left part. Merge (a, b) waits for all of b, and for whatever may take b, or a right
        end of b while it was being built, away by an earlier merge.
        """
        built = {a + b: b for a, b in self.merges}
        reach: dict[bytes, int] = {}
        longest = 0
        for a, b in self.merges:
            further, end = 0, b
            while end:
                further = max(further, reach.get(end, 0))
                end = built.get(end, b"")
            reach[a] = max(reach.get(a, 0), len(b) + further)
            longest = max(longest, reach[a])
        return longest

    def merged(self, content: bytes) -> list[int]:
        """The tokens of a byte string: always the earliest merge of the list, leftmost first."""
        if len(content) > 64:
            return self._merged_long(content)
        rank_of, products = self.ranks.get, self.products
        tokens = [self.single[byte] for byte in content]
        ranks = [rank_of((a << 20) + b, NEVER) for a, b in zip(tokens, tokens[1:], strict=False)]
        while ranks and (best := min(ranks)) < NEVER:
            at = ranks.index(best)
            token = tokens[at] = products[best]
            del tokens[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of((token << 20) + tokens[at + 1], NEVER)
            if at:
                ranks[at - 1] = rank_of((tokens[at - 1] << 20) + token, NEVER)
        return tokens

    def _merged_long(self, content: bytes) -> list[int]:
        """The same with a queue of merges, for strings where searching the list would be slow."""
        tokens = [self.single[byte] for byte in content]
        after, before = [*range(1, len(tokens)), -1], [*range(-1, len(tokens) - 1)]
        queue: list[tuple[int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                rank = self.ranks.get((tokens[left] << 20) + tokens[right], NEVER)
                if rank < NEVER:
                    heapq.heappush(queue, (rank, left))

        for at in range(len(tokens) - 1):
            offer(at, at + 1)
        while queue:
            rank, at = heapq.heappop(queue)
            right = after[at]
            if tokens[at] < 0 or right < 0 or self.ranks.get((tokens[at] << 20) + tokens[right]) != rank:
                continue  # one of the two has been merged meanwhile
            tokens[at], tokens[right] = self.products[rank], -1
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
            offer(at, after[at])
            offer(before[at], at)
        return [token for token in tokens if token >= 0]


class Transducer:
    """Bytes of one pre-token in, tokens out as soon as they are final."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.buffer = b""

    def feed(self, content: bytes) -> list[int]:
        self.buffer += content
        keep = self.vocabulary.lookahead
        if len(self.buffer) < 4 * keep + WHOLE:
            return []
        final, end = [], 0
        for token in self.vocabulary.merged(self.buffer):
            size = len(self.vocabulary.contents[token])
            if end + size > len(self.buffer) - keep:
                break
            final.append(token)
            end += size
        self.buffer = self.buffer[end:]
        return final

    def finish(self) -> list[int]:
        last, self.buffer = self.vocabulary.merged(self.buffer), b""
        return last


class _Remembered(dict):
    """Pre-token to its tokens."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        tokens = self.older.get(word)
        if tokens is None:
            tokens = tuple(self.vocabulary.merged(word.encode()))
        if len(word) <= 64:
            if 2 * len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = tokens
        return tokens


class Encoder:
    """Texts to token ids, in pieces."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.general = regex.compile(PATTERN)
        self.latin = re.compile(LATIN)
        self.beyond_latin = re.compile("[^\x00-\u024f]")
        self.known = _Remembered(vocabulary)

    @classmethod
    def of(cls, definition: str) -> Encoder:
        """An encoder kept by the worker, so that its tasks read the file's merges once."""
        memory, key = worker_memory(), ("encoder", hashlib.sha256(definition.encode()).digest())
        if key not in memory:
            memory[key] = cls(Vocabulary(definition))
        return memory[key]

    def encode(self, text: str) -> Iterator[list[int]]:
        """The ids of a text piece by piece; special tokens in the text are kept whole."""
        self.pattern = self.general if self.beyond_latin.search(text) else self.latin
        at = 0
        for special in self.vocabulary.special_pattern.finditer(text):
            yield from self._plain(text, at, special.start())
            yield [self.vocabulary.specials[special.group()]]
            at = special.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, at: int, end: int) -> Iterator[list[int]]:
        known = self.known
        while at < end:
            stop = min(end, at + PIECE)
            words = self.pattern.findall(text[at:stop])
            if stop < end:
                # the last two pre-tokens may read on: white space leaves its last character to a word
                stop -= sum(map(len, words[-2:]))
                words = words[:-2]
                if not words:
                    yield from self._long(text, at, end)
                    at = self.pattern.match(text, at, end).end()
                    continue
            tokens: list[int] = []
            for word in words:
                if len(word) > WHOLE:
                    transducer = Transducer(self.vocabulary)
                    for start in range(0, len(word), WHOLE):
                        tokens += transducer.feed(word[start : start + WHOLE].encode())
                    tokens += transducer.finish()
                else:
                    tokens += known[word]
            yield tokens
            at = stop

    def _long(self, text: str, at: int, end: int) -> Iterator[list[int]]:
        """One pre-token longer than a piece."""
        last = self.pattern.match(text, at, end).end()
        transducer = Transducer(self.vocabulary)
        for start in range(at, last, WHOLE):
            yield transducer.feed(text[start : min(last, start + WHOLE)].encode())
        yield transducer.finish()


def decode(vocabulary: Vocabulary, pieces: Iterable[list[int]]) -> Iterator[str]:
    """Text of token ids piece by piece; bytes that are no UTF-8 become U+FFFD."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    contents = vocabulary.contents
    for ids in pieces:
        yield machine.decode(b"".join([contents[token] for token in ids]))
    yield machine.decode(b"", final=True)


def _digest_batches(batches: Iterator[pa.RecordBatch], definition: str) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_sha256", pa.string()),
            ("decoded_sha256", pa.string()),
        ]
    )
    encoder = Encoder.of(definition)
    for batch in sliced(batches, "text", 1 << 24):
        counts, of_ids, of_texts = [], [], []
        for text in batch.column("text").to_pylist():
            count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()

            def pieces(text=text, ids_hash=ids_hash):
                nonlocal count
                for ids in encoder.encode(text):
                    count += len(ids)
                    ids_hash.update(np.array(ids, dtype="<u4").tobytes())
                    yield ids

            for part in decode(encoder.vocabulary, pieces()):
                text_hash.update(part.encode())
            counts.append(count)
            of_ids.append(ids_hash.hexdigest())
            of_texts.append(text_hash.hexdigest())
        yield record_batch(schema, batch.column("doc_id"), counts, of_ids, of_texts)


def _id_batches(batches: Iterator[pa.RecordBatch], definition: str) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    encoder = Encoder.of(definition)
    for batch in sliced(batches, "text", 1 << 24):
        ids = [[i for part in encoder.encode(t) for i in part] for t in batch.column("text").to_pylist()]
        yield record_batch(schema, batch.column("doc_id"), ids)


def _text_batches(batches: Iterator[pa.RecordBatch], definition: str) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    vocabulary = Encoder.of(definition).vocabulary
    for batch in batches:
        texts = ["".join(decode(vocabulary, [ids or []])) for ids in batch.column("ids").to_pylist()]
        yield record_batch(schema, batch.column("doc_id"), texts)


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(docs[id].cast("long").alias("doc_id"), text_of(docs, text).alias("text"))


def encoded(docs: DataFrame, definition: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row; a null text has no ids. ``definition`` is a tokenizer file's JSON."""
    return _texts(docs, id, text).mapInArrow(
        partial(_id_batches, definition=definition), "doc_id long, ids array<int>"
    )


def decoded(rows: DataFrame, definition: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids) rows; null ids give an empty text."""
    return rows.select("doc_id", "ids").mapInArrow(
        partial(_text_batches, definition=definition), "doc_id long, text string"
    )


def round_trip(docs: DataFrame, definition: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row.

    Texts are encoded and decoded in pieces, so a very long text needs its own bytes and no more.
    Defined cases: a null text is an empty one; null and repeated ids keep their own rows;
    other columns of ``docs`` are not looked at. There is no shuffle.
    """
    return _texts(docs, id, text).mapInArrow(
        partial(_digest_batches, definition=definition),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
