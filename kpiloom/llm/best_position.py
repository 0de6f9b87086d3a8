"""Ranked lexical search by the Best Position Algorithm over impact lists.

A query's terms each have an impact list: the documents that hold the term, by falling impact. All
lists are read downwards together (sorted access); for each document that comes up, its places in the
other lists are looked up (direct access), which gives its whole score. Each list remembers which of
its places were seen by either kind of access; its best position is the end of the run of seen places
at its head. A document not seen yet stands behind the best position in every list, so the impacts
there add up to a bound on its score, and the bound is tighter than that of the last places read.
Reading stops once the bound is strictly below the k-th score: an equal score could still win by its
document's id.

Lists are built per shard, a few megabytes of text, from statistics of the whole corpus. A task carries
its k best documents per query from shard to shard, so later shards stop earlier; what it returns is k
rows per query, and Spark ranks these in two steps. The text is read once for the statistics and once
for the lists; no list is written or shuffled.

Queries are taken in blocks of a bounded number of (query, term) pairs, each block a further pass. Rows
with one item_id are one query of all their terms, null ids likewise; an item without terms has no row. A
document without text has no terms and is never found. Rows with one doc_id are documents each;
null ids rank behind others of the same score. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kpiloom.llm import storage, text

#: Text whose impact lists are built at once, and (query, term) pairs sent to the tasks at once.
SHARD_BYTES, BLOCK_PAIRS = 4 << 20, 1 << 20

#: Places read from every list before the bound is first looked at; doubled each time.
FIRST_PLACES = 16

#: Groups in which a query's documents are ranked first.
RANK_GROUPS = 64

#: The weights of length and occurrence in an impact, fixed: 10 + 90 * length / mean length, and so on.
LENGTH_SHARE, OCCURRENCE_SCALE, TERM_SCALE = 90, 1_000_000_000, 1000

_DOCUMENTS, _TERMS = -1, -2


@dataclass
class Queries:
    """Queries over a vocabulary: query i has the terms flat[first[i]:first[i+1]]."""

    item_ids: list
    vocabulary: pa.BinaryArray
    flat: np.ndarray
    first: np.ndarray


@dataclass
class Statistics:
    """Documents with a term, all terms with repeats, and the documents of each vocabulary term."""

    documents: int
    terms: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        top = 2 * self.documents + 2
        return np.array([math.floor(1000 * math.log(top / (2 * int(df) + 1))) for df in self.holding], np.int64)

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """What a document of n terms has in place of its length."""
        if not self.terms:
            return np.full(len(n), 100 - LENGTH_SHARE, np.int64)
        if LENGTH_SHARE * int(n.max(initial=0)) * self.documents < 1 << 62:
            share = LENGTH_SHARE * n * self.documents // self.terms
        else:
            share = np.array([LENGTH_SHARE * int(x) * self.documents // self.terms for x in n], np.int64)
        return 100 - LENGTH_SHARE + share


def _pairs(items: DataFrame) -> DataFrame:
    """The different (item_id, term) pairs of all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in text.slices(batch["text"], SHARD_BYTES):
                w = text.words(part, text.ALNUM_LOWER)
                different, codes = w.coded()
                pair = np.unique(w.text_of() * max(len(different), 1) + codes)
                row, term = np.divmod(pair, max(len(different), 1))
                yield pa.RecordBatch.from_pydict(
                    {"item_id": batch["item_id"].slice(a, b - a).take(pa.array(row)), "term": different.take(pa.array(term))}
                )

    kind = items.schema["item_id"].dataType.simpleString()
    texts = items.select("item_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"item_id {kind}, term binary").distinct()


def _blocks(items: DataFrame) -> Iterator[Queries]:
    pairs = storage.written(_pairs(items), "search-terms")
    n = math.ceil(pairs.count() / BLOCK_PAIRS)
    for k in range(n):
        block = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).orderBy("item_id", "term").toArrow()
        if not block.num_rows:
            continue
        ids = block["item_id"].combine_chunks()
        term = block["term"].combine_chunks().dictionary_encode()
        number = ids.dictionary_encode(null_encoding="encode")
        first = np.flatnonzero(np.diff(number.indices.to_numpy(zero_copy_only=False), prepend=-1, append=-1))
        yield Queries(number.dictionary.to_pylist(), term.dictionary, term.indices.to_numpy(zero_copy_only=False).astype(np.int64), first)


def _occurrences(part: text.Raw, vocabulary: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The terms of each document, and document, term and count of each occurring vocabulary term,
    by document and term."""
    w = text.words(part, text.ALNUM_LOWER)
    different, codes = w.coded()
    known = pc.index_in(different, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    term = known[codes] if len(known) else np.zeros(0, np.int64)
    held = term >= 0
    pair, times = np.unique(w.text_of()[held] * len(vocabulary) + term[held], return_counts=True)
    doc, term = np.divmod(pair, len(vocabulary))
    return w.counts, doc, term, times.astype(np.int64)


def statistics(docs: DataFrame, vocabulary: pa.BinaryArray) -> Statistics:
    """Counts over all documents; what comes to the driver is a number per vocabulary term."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        holding, documents, terms = np.zeros(len(own), np.int64), 0, 0
        for batch in batches:
            for _, _, part in text.slices(batch["text"], SHARD_BYTES):
                counts, _, term, _ = _occurrences(part, own)
                holding += np.bincount(term, minlength=len(own))
                documents += int((counts > 0).sum())
                terms += int(counts.sum())
        used = np.flatnonzero(holding)
        yield pa.RecordBatch.from_pydict(
            {
                "term": pa.array(np.concatenate([[_DOCUMENTS, _TERMS], used]), pa.int64()),
                "n": pa.array(np.concatenate([[documents, terms], holding[used]]), pa.int64()),
            }
        )

    texts = docs.select(F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = dict(zip(counted["term"].to_pylist(), counted["n"].to_pylist(), strict=True))
    holding = np.array([total.get(t, 0) for t in range(len(vocabulary))], np.int64)
    return Statistics(total.get(_DOCUMENTS, 0), total.get(_TERMS, 0), holding)


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin[i], begin[i] + 1, ... of all runs, one run after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)


class Shard:
    """Impact lists of the vocabulary's terms, and for direct access the places of each document."""

    def __init__(self, part: text.Raw, doc_ids: pa.Array, vocabulary: pa.BinaryArray, weights: np.ndarray, stats: Statistics):
        counts, doc, term, times = _occurrences(part, vocabulary)
        length = stats.lengths(counts)
        impact = weights[term] * ((OCCURRENCE_SCALE * times) // (TERM_SCALE * times + 8 * length[doc]))
        self.doc_ids = doc_ids
        # Equal scores go by the document's id, null ids last.
        self.by_id = np.empty(len(doc_ids), np.int64)
        self.by_id[pc.sort_indices(doc_ids, null_placement="at_end").to_numpy()] = np.arange(len(doc_ids))
        # By document: where each one's terms begin, the terms, and the place of each in its list.
        self.of_doc = np.searchsorted(doc, np.arange(len(doc_ids) + 1))
        self.term, self.gain = term, impact
        order = np.lexsort((doc, -impact, term))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        # By term: where each list begins, its documents and impacts.
        self.of_term = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
        self.list_doc, self.list_impact = doc[order], impact[order]
        # Marks of one query, cleared behind it.
        self.found = np.zeros(len(doc_ids), bool)
        self.seen = np.zeros(len(order), bool)
        self.asked = np.zeros(len(vocabulary), bool)

    def search(self, terms: np.ndarray, k: int, kth: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the k best, best first, and their scores. ``kth`` is the k-th
        score so far (0 if there are fewer); what is below it need not be found."""
        begin, end = self.of_term[terms], self.of_term[terms + 1]
        terms, begin, end = terms[end > begin], begin[end > begin], end[end > begin]
        best = np.zeros(0, np.int64)
        scores = np.zeros(0, np.int64)
        best_place = begin.copy()  # the first place of each list that was not seen
        self.asked[terms] = True
        met, marked = [], []
        depth, step = 0, FIRST_PLACES
        while True:
            rest = best_place < end
            bound = int(self.list_impact[best_place[rest]].sum())
            if not rest.any() or bound < kth or bound == 0:
                break
            # Sorted access: the next places of every list.
            size = np.clip(end - begin - depth, 0, step)
            new = self.list_doc[_runs(begin + depth, size)]
            new = np.unique(new[~self.found[new]])
            self.found[new] = True
            met.append(new)
            # Direct access: all places of the new documents in the lists.
            size = self.of_doc[new + 1] - self.of_doc[new]
            held = _runs(self.of_doc[new], size)
            asked = self.asked[self.term[held]]
            total = np.zeros(len(held) + 1, np.int64)
            np.cumsum(np.where(asked, self.gain[held], 0), out=total[1:])
            ends = np.cumsum(size)
            score = total[ends] - total[ends - size]
            places = self.place[held[asked]]
            self.seen[places] = True
            marked.append(places)
            # The k best so far.
            good = (score >= max(kth, 1)).nonzero()[0]
            best, scores = np.concatenate([best, new[good]]), np.concatenate([scores, score[good]])
            order = np.lexsort((self.by_id[best], -scores))[:k]
            best, scores = best[order], scores[order]
            if len(best) == k:
                kth = max(kth, int(scores[-1]))
            # Best positions: the runs of seen places at the heads of the lists grow.
            depth += step
            step *= 2
            for j in np.flatnonzero(rest):
                unseen = ~self.seen[best_place[j] : end[j]]
                best_place[j] = best_place[j] + int(unseen.argmax()) if unseen.any() else end[j]
        self.asked[terms] = False
        for docs in met:
            self.found[docs] = False
        for places in marked:
            self.seen[places] = False
        return best, scores


def top(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of every item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read.
    """
    spark = docs.sparkSession
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {item_kind}, doc_id {id_kind}, score bigint"
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = [_search(texts, queries, k, schema) for queries in _blocks(items)]
    rows = reduce(DataFrame.unionByName, found, spark.createDataFrame([], schema))
    # In two steps, so that no task gets an item's rows of all tasks.
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    group = F.pmod(F.xxhash64("doc_id", "score"), F.lit(RANK_GROUPS))
    first = rows.withColumn("group", group).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "group").orderBy(*order)))
    last = first.filter(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return last.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search(texts: DataFrame, queries: Queries, k: int, schema: str) -> DataFrame:
    stats = statistics(texts, queries.vocabulary)
    shipped = texts.sparkSession.sparkContext.broadcast((vars(queries), vars(stats)))
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = Queries(**shipped.value[0]), Statistics(**shipped.value[1])
        weights = known.weights()
        # The k best of each query so far, best first: (-score, id is null, id).
        kept: list[list[tuple]] = [[] for _ in own.item_ids]
        for batch in batches:
            for a, b, part in text.slices(batch["text"], SHARD_BYTES):
                shard = Shard(part, batch["doc_id"].slice(a, b - a), own.vocabulary, weights, known)
                for i, best in enumerate(kept):
                    kth = -best[-1][0] if len(best) == k else 0
                    rows, scores = shard.search(own.flat[own.first[i] : own.first[i + 1]], k, kth)
                    if len(rows):
                        ids = shard.doc_ids.take(pa.array(rows)).to_pylist()
                        new = [(-s, d is None, d) for s, d in zip(scores.tolist(), ids, strict=True)]
                        kept[i] = sorted(best + new, key=lambda x: x[:2] + (() if x[1] else x[2:]))[:k]
        out = [(own.item_ids[i], d, -s) for i, best in enumerate(kept) for s, _, d in best]
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    kinds = [to_arrow_type(f.dataType) for f in texts.sparkSession.createDataFrame([], schema).schema]
    return texts.mapInArrow(run, schema)
