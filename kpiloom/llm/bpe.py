"""Byte-level BPE encoding and decoding by replaying the merges over a corpus of words.

A pattern splits a text into words; each word is encoded on its own, so a slice of texts is first
reduced to the different words that its task has not met before. Those words form one corpus: their
bytes stand one after the other as a linked row of tokens, and an inverted index leads from each
merge (the rank of a pair of neighbouring tokens) to the places of its left tokens. Merges are
applied in the order of their ranks, each at all its places in all words; a merge touches its two
neighbours only, whose new pairs enter the index.

A word's own order must be that of taking its lowest pair first, the leftmost of equals. Where a merge
makes a pair of a lower rank than its own, the rest of that word therefore goes back into the index
and waits for the lower rank. A word that is itself in the vocabulary is that one token.

Null and empty texts have no tokens. Nothing is shuffled: a row is encoded where it is read. A long
text is a slice of its own, and a long word a corpus of its own.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import text

#: Text reduced to its different words at once, and bytes of words replayed at once.
SLICE_BYTES, CORPUS_BYTES = 4 << 20, 1 << 20

#: A task remembers so many words of at most so many characters; then it begins anew.
MEMORY_WORDS, MEMORY_CHARS = 1 << 19, 64

#: Vocabularies are sent to every task; a larger one is refused.
MAX_TOKENS = 1 << 20


@dataclass
class Vocabulary:
    """Tokens by id (the id is the rank of the merge that makes the token), and the word pattern."""

    tokens: list[bytes]
    pattern: str

    def __post_init__(self) -> None:
        self.ranks = {token: rank for rank, token in enumerate(self.tokens)}
        if len(self.ranks) > MAX_TOKENS or len(self.ranks) != len(self.tokens):
            raise ValueError("a vocabulary holds each token once, and 2^20 of them at most")
        singles = [self.ranks.get(bytes([b])) for b in range(256)]
        if None in singles:
            raise ValueError("a byte-level vocabulary holds all single bytes")
        self.single = np.array(singles, np.int32)
        #: The merge of each pair of bytes, -1 if there is none.
        self.byte_pairs = np.array([self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)
        self.split = regex.compile(self.pattern).findall


def load(path: str, pattern: str) -> Vocabulary:
    """Read a rank file: a line for each token, its bytes in base64 and its rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("the ranks of a vocabulary begin at 0 and have no gap")
    return Vocabulary([ranks[rank] for rank in range(len(ranks))], pattern)


def replay(words: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """The ids of each word as int32, all words of the corpus being merged together."""
    data = np.frombuffer(b"".join(words), np.uint8)
    first = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(word) for word in words], out=first[1:])
    starts = first.tolist()
    merges = np.full(len(data), -1, np.int32)
    if len(data) > 1:
        merges[:-1] = vocabulary.byte_pairs[data[:-1].astype(np.int32) * 256 + data[1:]]
    after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
    last, filled = first[1:] - 1, np.diff(first) > 0
    merges[last[filled]] = -1  # no pair reaches from a word into the next
    after[last[filled]] = -1
    before[first[:-1][filled]] = -1

    places = np.flatnonzero(merges >= 0)
    places = places[np.argsort(merges[places], kind="stable")]
    order, begin = np.unique(merges[places], return_index=True)
    index = {r: part.tolist() for r, part in zip(order.tolist(), np.split(places, begin[1:]), strict=True)} if len(order) else {}
    waiting = list(index)
    heapify(waiting)

    token, after, before, pair = vocabulary.single[data].tolist(), after.tolist(), before.tolist(), merges.tolist()
    tokens, rank_of = vocabulary.tokens, vocabulary.ranks.get
    while waiting:
        rank = heappop(waiting)
        merged, held_until = tokens[rank], -1
        for at in sorted(index.pop(rank)):
            if pair[at] != rank:  # left behind by a merge that took one of its two tokens
                continue
            if at < held_until:
                _enter(index, waiting, rank, at)
                continue
            right = after[at]
            end, left, lowest = after[right], before[at], rank
            token[at], token[right], pair[at], pair[right], after[at] = rank, -1, -1, -1, end
            if end >= 0:
                before[end] = at
                new = rank_of(merged + tokens[token[end]])
                if new is not None:
                    pair[at] = new
                    _enter(index, waiting, new, at)
                    if new < lowest:
                        lowest = new
            if left >= 0:
                new = rank_of(tokens[token[left]] + merged)
                if new is None:
                    pair[left] = -1
                else:
                    pair[left] = new
                    _enter(index, waiting, new, left)
                    if new < lowest:
                        lowest = new
            if lowest < rank:
                held_until = starts[bisect_right(starts, at)]

    ids = np.array(token, np.int32)
    kept = np.flatnonzero(ids >= 0)
    cuts = (np.searchsorted(kept, first) * 4).tolist()
    ids = ids[kept].tobytes()
    return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _enter(index: dict[int, list[int]], waiting: list[int], rank: int, at: int) -> None:
    places = index.get(rank)
    if places is None:
        index[rank] = [at]
        heappush(waiting, rank)
    else:
        places.append(at)


class Encoder:
    """Encodes the texts of one task, and remembers the words that it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known = vocabulary, {}

    def _learn(self, words: set[str]) -> None:
        names: list[str] = []
        corpus: list[bytes] = []
        size = 0
        for word in words:
            data = word.encode()
            whole = self.vocabulary.ranks.get(data)
            if whole is not None:
                self.known[word] = np.int32(whole).tobytes()
                continue
            if corpus and size + len(data) > CORPUS_BYTES:
                self.known.update(zip(names, replay(corpus, self.vocabulary), strict=True))
                names, corpus, size = [], [], 0
            names.append(word)
            corpus.append(data)
            size += len(data)
        self.known.update(zip(names, replay(corpus, self.vocabulary), strict=True))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and each text's first one."""
        if len(self.known) > MEMORY_WORDS:
            self.known = {}
        split = self.vocabulary.split
        words = [split(t) if t else [] for t in texts]
        new = set().union(*words).difference(self.known)
        self._learn(new)
        coded = [b"".join(map(self.known.__getitem__, part)) for part in words]
        first = np.zeros(len(coded) + 1, np.int64)
        np.cumsum([len(p) // 4 for p in coded], out=first[1:])
        for word in new:
            if len(word) > MEMORY_CHARS:
                del self.known[word]
        return np.frombuffer(b"".join(coded), np.int32), first


def decode_slice(vocabulary: Vocabulary, ids: np.ndarray, first: np.ndarray) -> pa.Array:
    """The bytes of each run of ids."""
    tokens = vocabulary.tokens
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < len(tokens):
        raise ValueError("an id is not in the vocabulary")
    flat = ids.tolist()
    return pa.array([b"".join(map(tokens.__getitem__, flat[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())


def _lists(ids: np.ndarray, first: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))


def _texts(docs: DataFrame) -> tuple[DataFrame, str]:
    return docs.select("doc_id", F.col("text").cast("string").alias("text")), docs.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id`` and ``ids``, a row for each row, repeated rows included. A null or empty text has
    no ids; a null doc_id stays null. Only doc_id and text are read."""
    return _run(docs, vocabulary, decoded=False)


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encode``, and ``decoded``: the bytes that its ids stand for."""
    return _run(docs, vocabulary, decoded=True)


def _run(docs: DataFrame, vocabulary: Vocabulary, decoded: bool) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast((vocabulary.tokens, vocabulary.pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(*shipped.value)
        encoder = Encoder(own)
        for batch in batches:
            for a, b, _ in text.slices(batch["text"], SLICE_BYTES):
                ids, first = encoder.encode(batch["text"].slice(a, b - a).to_pylist())
                columns = {"doc_id": batch["doc_id"].slice(a, b - a), "ids": _lists(ids, first)}
                if decoded:
                    columns["decoded"] = decode_slice(own, ids, first)
                yield pa.RecordBatch.from_pydict(columns)

    texts, kind = _texts(docs)
    return texts.mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The rows of ``encoded`` with ``decoded``, the bytes of their ``ids``; null ids give none. An id
    that the vocabulary does not have is an error."""
    shipped = encoded.sparkSession.sparkContext.broadcast((vocabulary.tokens, vocabulary.pattern))
    names = [name for name in encoded.columns if name != "decoded"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(*shipped.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                size = pc.list_value_length(part["ids"]).fill_null(0).to_numpy(zero_copy_only=False)
                first = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
                flat = part["ids"].flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*(part[n] for n in names), decode_slice(own, flat, first)], [*names, "decoded"])

    return encoded.select(*names).mapInArrow(run, f"{kinds}, decoded binary")


def digest(coded: DataFrame) -> DataFrame:
    """One row per row of ``round_trip``: number of ids, a hash over them, a hash of the bytes."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
