"""Benchmark decontamination with suffix arrays of the training texts.

Each slice of documents is a shard: its suffixes are put in order by their words, and the suffixes
of all benchmark items are searched in that order by bisection. A suffix of an item that finds a
training suffix with the same first ``window`` words is a verbatim match; neighbouring matches on
one diagonal make up the longest match of item and document, whose place is given. Shards live
within a task: nothing is shuffled, and documents with any match can be dropped on the way.

Training suffixes that cannot match are left out of the array before it is sorted: a match has only
pairs of neighbouring words that some item has too. That loses nothing.

The benchmark is the stated query set. It is taken in blocks of at most ``BLOCK_BYTES`` of text
(or one item), so what is broadcast is bounded; each further block is a further pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import storage, text

#: Text of the benchmark searched for in one pass.
BLOCK_BYTES = 16 << 20

#: Bytes of documents in one suffix array.
SHARD_BYTES = 8 << 20

SPANS = "array<struct<start: bigint, end: bigint>>"
MATCHES = "array<struct<item_id: string, item_start: bigint, doc_start: bigint, n_words: bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_MATCHES = pa.list_(
    pa.struct(
        [("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("n_words", pa.int64())]
    )
)


@dataclass
class TestSet:
    """A block of benchmark items: their words as numbers, and the windows to look for."""

    item_ids: list[str]
    vocabulary: pa.BinaryArray
    pairs: np.ndarray  # sorted codes of neighbouring words
    windows: np.ndarray  # a row of words for each window, padded with -1
    lengths: np.ndarray
    item: np.ndarray
    place: np.ndarray


def test_set(items: pa.Table, window: int) -> TestSet:
    w = text.words(text.raw(items["text"]), text.ALNUM_LOWER)
    vocabulary, codes = w.coded()
    n = w.counts
    many = np.where(n >= window, n - window + 1, np.minimum(n, 1))
    item = np.repeat(np.arange(len(n)), many)
    place = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
    lengths = np.minimum(n, window)[item]
    start = w.first[:-1][item] + place
    windows = _rows(codes, start, lengths, window)
    first, second = codes[:-1].astype(np.int64), codes[1:].astype(np.int64)
    inside = np.diff(w.text_of()) == 0
    pairs = np.sort(first[inside] * max(len(vocabulary), 1) + second[inside])
    return TestSet(items["item_id"].to_pylist(), vocabulary, pairs, windows, lengths, item, place)


def _rows(codes: np.ndarray, start: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The words from each start on, as rows of ``width``; -1 beyond the row's length."""
    at = start[:, None] + np.arange(width)
    rows = codes[np.minimum(at, max(len(codes) - 1, 0))] if len(codes) else np.zeros(at.shape, np.int32)
    return np.where(np.arange(width) < lengths[:, None], rows, -1).astype(np.int32)


def _contains(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


@dataclass
class SuffixArray:
    """Suffixes of a shard in the order of their first words."""

    starts: np.ndarray
    rows: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray, doc: np.ndarray, tests: TestSet) -> SuffixArray:
        window = tests.windows.shape[1]
        n = len(codes)
        # reach: words from here on whose neighbouring pairs all occur in the test set.
        known = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0) & (doc[:-1] == doc[1:])) if n > 1 else np.zeros(0, int)
        pairs = codes[known].astype(np.int64) * max(len(tests.vocabulary), 1) + codes[known + 1]
        joined = np.zeros(n, bool)
        joined[known[_contains(tests.pairs, pairs)]] = True
        broken = np.where(joined, n, np.arange(n))
        reach = np.minimum.accumulate(broken[::-1])[::-1] - np.arange(n) + 1
        least = int(tests.lengths.min())
        starts = np.flatnonzero((codes >= 0) & (reach >= least))
        rows = _rows(codes, starts, reach[starts], window)
        order = np.lexsort(rows.T[::-1])
        return cls(starts[order], rows[order])

    def find(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window the run of suffixes that begin with it, by bisection."""
        bounds = []
        width = windows.shape[1]
        for after_equal in (False, True):
            low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(self.starts), np.int64)
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) // 2
                there, wanted = self.rows[middle], windows[open_]
                differs = (there != wanted) & (np.arange(width) < lengths[open_, None])
                at = differs.argmax(1)
                pick = np.arange(len(open_))
                unequal = differs[pick, at]
                right = np.where(unequal, there[pick, at] < wanted[pick, at], after_equal)
                low[open_] = np.where(right, middle + 1, low[open_])
                high[open_] = np.where(right, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            bounds.append(low)
        return bounds[0], bounds[1]


@dataclass
class Found:
    """Matches in a shard: window of the test set, place in the shard's words, length."""

    words: text.Words
    window: np.ndarray
    at: np.ndarray
    length: np.ndarray


def search_shard(shard: text.Raw, tests: TestSet) -> Found:
    w = text.words(shard, text.ALNUM_LOWER)
    none = np.zeros(0, np.int64)
    if not len(w) or not len(tests.lengths):
        return Found(w, none, none, none)
    different, codes = w.coded()
    known = pc.index_in(different, value_set=tests.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
    suffixes = SuffixArray.of(known[codes], w.text_of(), tests)
    if not len(suffixes.starts):
        return Found(w, none, none, none)
    low, high = suffixes.find(tests.windows, tests.lengths)
    times = high - low
    window = np.repeat(np.arange(len(times)), times)
    at = suffixes.starts[np.arange(len(window)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)]
    return Found(w, window, at, tests.lengths[window])


def _spans(found: Found, earlier: list | None, rows: int) -> list[list[dict]]:
    """Hit words of each text as runs, together with those of earlier passes."""
    step = np.zeros(len(found.words) + 1, np.int64)
    np.add.at(step, found.at, 1)
    np.add.at(step, found.at + found.length, -1)
    first = found.words.first
    for i, spans in enumerate(earlier or []):
        for span in spans:
            step[first[i] + span["start"]] += 1
            step[first[i] + span["end"]] -= 1
    hit = np.cumsum(step)[:-1] > 0
    out: list[list[dict]] = [[] for _ in range(rows)]
    places = np.flatnonzero(hit)
    if len(places):
        doc = np.searchsorted(first, places, "right") - 1
        new = np.flatnonzero(np.diff(places, prepend=-2) != 1)
        new = np.union1d(new, np.flatnonzero(np.diff(doc, prepend=-1)))
        for a, b in zip(new, np.append(new[1:], len(places)), strict=True):
            i = int(doc[a])
            out[i].append({"start": int(places[a] - first[i]), "end": int(places[b - 1] - first[i] + 1)})
    return out


def _longest(found: Found, tests: TestSet, rows: int) -> list[list[dict]]:
    """The longest match of each text and item; of equals the first in the text."""
    out: list[list[dict]] = [[] for _ in range(rows)]
    if not len(found.at):
        return out
    doc = np.searchsorted(found.words.first, found.at, "right") - 1
    item, place = tests.item[found.window], tests.place[found.window]
    diagonal = found.at - place
    order = np.lexsort((found.at, diagonal, item, doc))
    doc, item, place, at, diagonal, length = (x[order] for x in (doc, item, place, found.at, diagonal, found.length))
    same = (np.diff(doc) == 0) & (np.diff(item) == 0) & (np.diff(diagonal) == 0) & (np.diff(at) == 1)
    new = np.flatnonzero(np.append(True, ~same))
    end = np.append(new[1:], len(at)) - 1
    size = at[end] - at[new] + length[end]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for a, n in zip(new, size, strict=True):
        key, match = (int(doc[a]), int(item[a])), (int(n), -int(at[a]), int(place[a]))
        if key not in best or match[:2] > best[key][:2]:
            best[key] = match
    for (i, k), (n, start, place_) in sorted(best.items()):
        out[i].append(
            {
                "item_id": tests.item_ids[k],
                "item_start": place_,
                "doc_start": -start - int(found.words.first[i]),
                "n_words": n,
            }
        )
    return out


def _blocks(benchmark: DataFrame, window: int, unnamed: bool) -> Iterator[TestSet]:
    """The items in blocks of bounded text, read one after the other. Null texts have no window."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.col("text").isNotNull() & (F.lit(unnamed) | F.col("item_id").isNotNull()))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    for k in range(n):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield test_set(block.toArrow(), window)


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, unnamed: bool = False) -> DataFrame:
    """Matches of benchmark items in documents: ``doc_id``, ``n_words``, ``hits`` (runs of words
    inside a window of some item) and ``matches`` (the longest match with each item).

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are not read. One
    row per row of ``docs``, repeated rows included. A null or empty text has no words and no hit.
    An item shorter than the window, but not empty, is one window. Items without text are left out,
    and those without id too unless ``unnamed``: the registered query and the pipeline search them.
    An empty benchmark hits nothing. Items with one id count as one item in digests; all without id
    count as one more, which has no name in the hash.
    """
    spark = docs.sparkSession
    out = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    for k, tests in enumerate(_blocks(benchmark, window, unnamed)):
        if k:  # one block at a time: a task does not hold the workers and data of all
            out = storage.written(out, "decontamination")
        shipped = spark.sparkContext.broadcast(vars(tests))

        def search(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            tests = TestSet(**shipped.value)
            for batch in batches:
                for a, b, shard in text.slices(batch["text"], SHARD_BYTES):
                    part = batch.slice(a, b - a)
                    found = search_shard(shard, tests)
                    again = "hits" in part.schema.names
                    matches = _longest(found, tests, b - a)
                    if again:
                        matches = [x + y for x, y in zip(part["matches"].to_pylist(), matches, strict=True)]
                    spans = _spans(found, part["hits"].to_pylist() if again else None, b - a)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part["doc_id"],
                            part["text"],
                            pa.array(found.words.counts, pa.int64()),
                            pa.array(spans, _SPANS),
                            pa.array(matches, _MATCHES),
                        ],
                        ["doc_id", "text", "n_words", "hits", "matches"],
                    )

        out = out.mapInArrow(search, f"doc_id {doc_id}, text string, n_words bigint, hits {SPANS}, matches {MATCHES}")
    return out.drop("text")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, unnamed: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, that no window of a benchmark item occurs in. Rows with
    null or empty text stay; ``unnamed`` as in ``find``."""
    spark = docs.sparkSession
    out = docs
    for k, tests in enumerate(_blocks(benchmark, window, unnamed)):
        if k:  # one block at a time: a task does not hold the workers and data of all
            out = storage.written(out, "decontamination")
        shipped = spark.sparkContext.broadcast(vars(tests))

        def keep(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            tests = TestSet(**shipped.value)
            for batch in batches:
                for a, b, shard in text.slices(batch["text"], SHARD_BYTES):
                    found = search_shard(shard, tests)
                    hit = np.zeros(b - a, bool)
                    hit[np.searchsorted(found.words.first, found.at, "right") - 1] = True
                    yield batch.slice(a, b - a).filter(pa.array(~hit))

        out = out.mapInArrow(keep, docs.schema)
    return out


def digest(found: DataFrame) -> DataFrame:
    """One row per document in figures: words, hit words, items, and a hash over the item ids."""
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
