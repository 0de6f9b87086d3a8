"""Vector codes: product quantisation whose nearest entries are found by Orchard's search.

Vectors become integers and are cut into equal consecutive parts. Each part position has a codebook
that begins as the parts of the vectors of smallest ids; a round assigns every part to its nearest
entry and moves each entry to the floored mean of its parts. All arithmetic is in integers, so the
result does not depend on how rows are dealt to tasks.

Orchard's search keeps, for every entry, all entries sorted by their distance from it. A walk has a
current entry and follows its list; a nearer entry becomes the current one and the walk goes on in
its list. Entries that were looked at are marked. By the triangle inequality an entry beyond twice the
current distance cannot be nearer, nor as near, so there the walk ends. The walks of all vectors of a
batch are advanced together, one place of each list at a time.

A round sends each task the codebooks (bounded by parts x entries x width) and gets back one sum per
component and task, added up by Spark; nothing per vector is kept between rounds.

Left out are vectors that are null, that hold a null or non-finite component, or whose length is not
the commonest one (of equally common lengths the largest). Repeated rows count each; equal ids at the
first entries are ordered by their vectors, null ids come last. An empty table has empty codebooks and
no codes. Components too large for sums of squares in 64 bits are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import storage

#: A code is one byte.
MAX_ENTRIES = 256

#: Vectors whose walks advance together.
BATCH_ROWS = 4096


class Codebook:
    """Entries of one part position with their distance-sorted lists of neighbours."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n = len(entries)
        gaps = np.empty((n, n), np.int64)
        for i in range(n):
            gaps[i] = ((entries - entries[i]) ** 2).sum(axis=1)
        self.neighbours = np.argsort(gaps, axis=1, kind="stable").astype(np.int32)
        self.gaps = np.take_along_axis(gaps, self.neighbours, axis=1)
        sums = entries.sum(axis=1)
        self.by_sum = np.argsort(sums, kind="stable")
        self.sums = sums[self.by_sum]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each vector, of equally near ones the first, and the squared distance."""
        n, size = len(vectors), len(self.entries)
        # A walk may begin anywhere; the entry whose components have the nearest sum is seldom far off.
        current = self.by_sum[np.minimum(np.searchsorted(self.sums, vectors.sum(axis=1)), size - 1)]
        distance = ((vectors - self.entries[current]) ** 2).sum(axis=1)
        seen = np.zeros((n, size), bool)
        seen[np.arange(n), current] = True
        place = np.zeros(n, np.int64)
        walking = np.arange(n)
        while len(walking):
            at, step = current[walking], place[walking]
            near = self.gaps[at, step] <= 4 * distance[walking]
            walking, entry = walking[near], self.neighbours[at[near], step[near]]
            place[walking] += 1
            new = ~seen[walking, entry]
            looking, entry = walking[new], entry[new]
            seen[looking, entry] = True
            found = ((vectors[looking] - self.entries[entry]) ** 2).sum(axis=1)
            best = distance[looking]
            better = (found < best) | ((found == best) & (entry < current[looking]))
            jumping = looking[better]
            current[jumping], distance[jumping], place[jumping] = entry[better], found[better], 0
            walking = walking[place[walking] < size]
        return current, distance


def integers(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id``, ``label`` and ``vector``: the floored multiples of the components, of the rows that
    are kept (see above)."""
    sound = F.col("embedding").isNotNull() & ~F.exists("embedding", _unsound)
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    kept = vectors.filter(sound).select("vec_id", "label", whole.alias("vector"))
    lengths = kept.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    commonest = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return kept.filter(F.size("vector") == (commonest["length"] if commonest else 0))


def _unsound(x: Column) -> Column:
    return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))


def _matrix(vectors: pa.Array, parts: int) -> np.ndarray:
    """The vectors of a batch as rows; too large components are refused."""
    rows = len(vectors)
    flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    matrix = flat.reshape(rows, -1) if rows else flat.reshape(0, 0)
    width = matrix.shape[1] // parts
    largest = max(int(flat.max(initial=0)), -int(flat.min(initial=0)))
    if 4 * largest * largest * max(width, 1) >= 1 << 60:
        raise OverflowError(f"components up to {largest} have squared distances beyond 64 bits")
    return matrix


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(a, BATCH_ROWS)


def fit(kept: DataFrame, parts: int = 4, entries: int = MAX_ENTRIES, rounds: int = 4) -> np.ndarray:
    """Codebooks [part, entry, component] after so many rounds over all rows of ``integers``."""
    if not 1 <= entries <= MAX_ENTRIES:
        raise ValueError(f"a codebook has 1 to {MAX_ENTRIES} entries")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()["vector"].combine_chunks()
    start = _matrix(first, parts)
    if start.shape[1] % parts:
        raise ValueError(f"vectors of {start.shape[1]} components cannot be cut into {parts} equal parts")
    width = start.shape[1] // parts
    books = start.reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    if not len(start):
        return books
    for _ in range(rounds):
        sums = _sums(kept, books).toArrow()
        moved = np.zeros(books.shape[:2] + (width + 1,), np.int64)
        moved.reshape(-1)[sums["slot"].to_numpy()] = sums["total"].to_numpy()
        total, count = moved[..., :width], moved[..., width:]
        books = np.where(count > 0, np.floor_divide(total, np.maximum(count, 1)), books)
    return books


def _sums(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """Sums of components, and behind them the count, of the parts of each entry."""
    shipped = kept.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shipped.value
        parts, size, width = books.shape
        own = [Codebook(book) for book in books]
        sums = np.zeros((parts, size, width + 1), np.int64)
        for batch in _batches(batches):
            matrix = _matrix(batch["vector"], parts).reshape(batch.num_rows, parts, width)
            for k, book in enumerate(own):
                entry, _ = book.nearest(matrix[:, k])
                order = np.argsort(entry, kind="stable")
                used, begin = np.unique(entry[order], return_index=True)
                if len(used):
                    sums[k, used, :width] += np.add.reduceat(matrix[order, k], begin, axis=0)
                    sums[k, used, width] += np.diff(np.append(begin, len(order)))
        used = np.repeat(sums[..., width].reshape(-1) > 0, width + 1)
        slot = np.flatnonzero(used)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(slot, pa.int64()), "total": pa.array(sums.reshape(-1)[slot], pa.int64())})

    rows = kept.select("vector").mapInArrow(add, "slot bigint, total bigint")
    return rows.groupBy("slot").agg(F.sum("total").alias("total"))


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (a byte for each part) and ``error``, the squared distances
    from the chosen entries added up; a row for each row of ``integers``."""
    shipped = kept.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shipped.value
        parts, _, width = books.shape
        own = [Codebook(book) for book in books]
        for batch in _batches(batches):
            matrix = _matrix(batch["vector"], parts).reshape(batch.num_rows, parts, width)
            found = [book.nearest(matrix[:, k]) for k, book in enumerate(own)]
            codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch["vec_id"],
                    "label": batch["label"],
                    "code": pa.array([row.tobytes() for row in codes], pa.binary()),
                    "error": pa.array(sum(distance for _, distance in found), pa.int64()),
                }
            )

    kinds = ", ".join(f"{name} {kept.schema[name].dataType.simpleString()}" for name in ("vec_id", "label"))
    return kept.mapInArrow(run, f"{kinds}, code binary, error bigint")


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The integer vectors that codes [row, part] stand for."""
    return np.concatenate([book[codes[:, k]] for k, book in enumerate(books)], axis=1)


def digest(encoded: DataFrame, books: np.ndarray) -> DataFrame:
    """Codes as hex digits, the error of each vector and of all vectors of its label, and a hash of
    the codebooks. Null labels are one label."""
    encoded = storage.written(encoded, "codes")
    of_label = encoded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    numbers = ",".join(map(str, books.reshape(-1).tolist()))
    return encoded.join(of_label, F.col("label").eqNullSafe(F.col("_label")), "left").select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )
