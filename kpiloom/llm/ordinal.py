"""Ordinal quality classifier: cumulative-link regression on graded ratings.

Grades 0 < 1 < ... share one weight vector over hashed words and word shapes; ordered thresholds
cut its score s into grades: P(grade <= k) = sigmoid(threshold[k] - s). A feature's value is the
logarithm of its count over that of the text's words (``PRIOR_WORDS`` more), so neither a long text
nor one word that fills a text gives a score beyond all others.

The fit takes a bounded sample of rated rows (``max_rows``, those of smallest id hash). Scoring
takes all rows, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import text

#: Buckets of hashed words and shapes: 1 MB of weights.
BITS = 18
MAX_ROWS = 4096
REPEAT = 0
ROUNDS = 80

#: A bucket is fitted if at least this share of the sample holds it.
LEAST_SHARE = 0.01
RIDGE = 1e-3

#: Words without weight added to each text, so that a short one is not judged by few words.
PRIOR_WORDS = 20


@dataclass
class Model:
    grades: list[float]
    thresholds: np.ndarray
    weights: np.ndarray


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def shapes(different: pa.BinaryArray) -> pa.BinaryArray:
    """Each word with its letters and digits reduced to their kind; a run of one kind counts once."""
    part = text.raw(different)
    kind = np.arange(256, dtype=np.uint8)
    kind[ord("A") : ord("Z") + 1] = ord("A")
    kind[ord("a") : ord("z") + 1] = ord("a")
    kind[0x80:] = ord("a")
    kind[ord("0") : ord("9") + 1] = ord("0")
    data = kind[part.data]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != data[:-1]) | ~np.isin(data[1:], np.frombuffer(b"Aa0", np.uint8))
    keep[part.offsets[:-1][np.diff(part.offsets) > 0]] = True
    total = np.concatenate([[0], np.cumsum(keep)])[part.offsets]
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(different), [None, pa.py_buffer(total.astype(np.int32)), pa.py_buffer(data[keep])]
    )


def features(texts: text.Raw) -> tuple[text.Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words, each word's place among the different ones, two buckets for each of these, and
    the words that repeat the one before (they have bucket ``REPEAT`` besides)."""
    w = text.words(texts, text.VISIBLE)
    different, codes = w.coded()
    low = text.Raw(*(lambda r: (text.VISIBLE_LOWER[r.data], r.offsets))(text.raw(different)))
    lower = pa.BinaryArray.from_buffers(
        pa.binary(), len(different), [None, pa.py_buffer(low.offsets.astype(np.int32)), pa.py_buffer(low.data)]
    )
    shift = np.uint64(64 - BITS)
    buckets = np.stack([text.hashes(lower, 1) >> shift, text.hashes(shapes(different), 2) >> shift], 1)
    repeat = np.zeros(len(codes), bool)
    repeat[1:] = codes[1:] == codes[:-1]
    repeat[w.first[:-1][w.counts > 0]] = False
    return w, codes, buckets.astype(np.int64), np.flatnonzero(repeat)


def counted(texts: text.Raw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and value of all features, in this order."""
    w, codes, buckets, repeat = features(texts)
    doc = w.text_of()
    key = (doc[:, None] << BITS | buckets[codes]).ravel()
    key = np.sort(np.append(key, doc[repeat] << BITS | REPEAT))
    new = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.diff(np.append(new, len(key)))
    key = key[new]
    doc = key >> BITS
    return doc, key & ((1 << BITS) - 1), np.log1p(times) / np.log1p(w.counts + PRIOR_WORDS)[doc]


def sample_features(rated: DataFrame) -> pa.Table:
    """Each row's grade and its buckets with their values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in text.slices(batch["text"]):
                doc, bucket, value = counted(part)
                offsets = pa.array(np.searchsorted(doc, np.arange(b - a + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["grade"].slice(a, b - a),
                        pa.ListArray.from_arrays(offsets, pa.array(bucket, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(value, pa.float32())),
                    ],
                    ["grade", "bucket", "value"],
                )

    return rated.mapInArrow(run, "grade double, bucket array<int>, value array<float>").toArrow()


def fit(docs: DataFrame, ratings: DataFrame, grade: str, max_rows: int = MAX_ROWS) -> Model:
    """A model of ``ratings[grade]`` from texts.

    Rows without id, text or grade teach nothing; an id rated more than once counts with its lowest
    grade. Without any rating the model has no grades, with one grade only it gives that grade.
    """
    rated = ratings.select("doc_id", F.col(grade).cast("double").alias("grade")).dropna()
    chosen = (
        rated.groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).dropna()
    # At most max_rows rows of two numbers are broadcast.
    table = sample_features(texts.join(F.broadcast(chosen), "doc_id").select("grade", "text").limit(max_rows))
    return fit_sample(table)


def minimise(loss, x: np.ndarray, rounds: int, memory: int = 10) -> np.ndarray:
    """Limited-memory quasi-Newton steps with halving until the loss falls."""
    value, gradient = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        step = -gradient
        kept = []
        for s, d in reversed(past):
            a = s @ step / (s @ d)
            step = step - a * d
            kept.append(a)
        if past:
            s, d = past[-1]
            step = step * (s @ d) / (d @ d)
        for (s, d), a in zip(past, reversed(kept), strict=True):
            step = step + s * (a - d @ step / (s @ d))
        size = 1.0 if past else min(1.0, 1.0 / max(np.abs(gradient).sum(), 1e-12))
        slope = gradient @ step
        for _ in range(30):
            new_value, new_gradient = loss(x + size * step)
            if new_value <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            return x
        moved, change = size * step, new_gradient - gradient
        x, value, gradient = x + moved, new_value, new_gradient
        if moved @ change > 1e-12:
            past = [*past, (moved, change)][-memory:]
        if np.abs(gradient).max() < 1e-6:
            break
    return x


def fit_sample(table: pa.Table) -> Model:
    grade = table["grade"].to_numpy()
    order = np.lexsort((table["bucket"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False), grade)) if len(grade) else []
    table = table.take(pa.array(order, pa.int64())).combine_chunks()
    grades, y = np.unique(table["grade"].to_numpy(), return_inverse=True)
    if len(grades) < 2:
        return Model(grades.tolist(), np.zeros(0), np.zeros(1 << BITS, np.float32))
    lists = table["bucket"].combine_chunks()
    bucket = lists.flatten().to_numpy()
    value = table["value"].combine_chunks().flatten().to_numpy().astype(np.float64)
    row = np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy(zero_copy_only=False))
    # Buckets in few texts get no weight: they would learn single texts by heart. The others are
    # scaled by their root mean square.
    in_texts = np.bincount(bucket, minlength=1 << BITS)
    held = in_texts[bucket] >= max(2, LEAST_SHARE * len(y))
    bucket, value, row = bucket[held], value[held], row[held]
    used, column = np.unique(bucket, return_inverse=True)
    scale = np.sqrt(np.bincount(column, value**2, len(used)) / len(y))
    value = value / scale[column]
    share_of = np.cumsum(np.bincount(y, minlength=len(grades)))[:-1] / len(y)
    first = np.log(share_of / (1 - share_of))
    free = np.concatenate([np.zeros(len(used)), first[:1], np.log(np.diff(first))])
    n = len(used)

    def loss(free: np.ndarray) -> tuple[float, np.ndarray]:
        thresholds = free[n] + np.concatenate([[0.0], np.cumsum(np.exp(free[n + 1 :]))])
        score = np.bincount(row, value * free[column], len(y))
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        high, low = sigmoid(edges[y + 1] - score), sigmoid(edges[y] - score)
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p / len(y), low * (1 - low) / p / len(y)
        gradient = np.zeros_like(free)
        gradient[:n] = np.bincount(column, value * (d_high - d_low)[row], n) + RIDGE * free[:n]
        by_edge = np.bincount(y, d_low, len(grades))[1:] - np.bincount(y, d_high, len(grades))[:-1]
        gradient[n] = by_edge.sum()
        gradient[n + 1 :] = np.cumsum(by_edge[::-1])[::-1][1:] * np.exp(free[n + 1 :])
        return -np.log(p).mean() + 0.5 * RIDGE * (free[:n] ** 2).sum(), gradient

    free = minimise(loss, free, ROUNDS)
    thresholds = free[n] + np.concatenate([[0.0], np.cumsum(np.exp(free[n + 1 :]))])
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = free[:n] / scale
    return Model(grades.tolist(), thresholds, weights)


def _score(model: dict, texts: text.Raw, cut: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade, and the probability of a grade of ``cut`` or more."""
    doc, bucket, value = counted(texts)
    s = np.bincount(doc, model["weights"][bucket] * value, len(texts))
    below = sigmoid(model["thresholds"][None, :] - s[:, None])
    up_to = np.concatenate([np.zeros((len(s), 1)), below, np.ones((len(s), 1))], 1)
    grades = np.array(model["grades"])
    return np.diff(up_to, axis=1) @ grades, 1.0 - up_to[:, int(np.searchsorted(grades, cut))]


def score(docs: DataFrame, model: Model, cut: float = 1.0, least: float = 0.5) -> DataFrame:
    """``doc_id``, ``expected_grade``, ``tail_probability`` of a grade of ``cut`` or more, and
    ``accepted`` (it is ``least`` or more), for each row.

    A null or empty text has no feature: its grade follows from the thresholds alone. A model
    without grades accepts all and gives nulls; one of a single grade gives this to all.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            for a, b, part in text.slices(batch["text"]):
                if own["grades"]:
                    expected, tail = _score(own, part, cut)
                    values = [pa.array(expected, pa.float64()), pa.array(tail, pa.float64()), pa.array(tail >= least)]
                else:
                    values = [pa.nulls(b - a, pa.float64()), pa.nulls(b - a, pa.float64()), pa.array(np.ones(b - a, bool))]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(a, b - a), *values],
                    ["doc_id", "expected_grade", "tail_probability", "accepted"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, expected_grade double, tail_probability double, accepted boolean"
    )


def select(docs: DataFrame, model: Model, cut: float = 1.0, least: float = 0.5) -> DataFrame:
    """The accepted rows of ``docs``, all columns."""
    shipped = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            if not own["grades"]:
                yield batch
                continue
            for a, b, part in text.slices(batch["text"]):
                yield batch.slice(a, b - a).filter(pa.array(_score(own, part, cut)[1] >= least))

    return docs.mapInArrow(run, docs.schema)
