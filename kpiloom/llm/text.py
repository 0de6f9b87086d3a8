"""Words of whole texts, as flat arrays.

Texts arrive as Arrow batches. A batch is cut into slices of a few megabytes (a longer text is a
slice of its own), and each slice is turned into one contiguous array of words, so that the work
per word is done by array operations and memory does not grow with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text handled at once.
SLICE_BYTES = 8 << 20

_SPACE = 0x20


def byte_map(keep: str, lower: bool) -> np.ndarray:
    """What becomes of each byte: a word byte stays (in lower case if asked for), others become a
    space. ``keep`` is ``visible`` (all but ASCII white space) or ``alnum`` (ASCII digits and
    letters and all bytes beyond ASCII)."""
    table = np.arange(256, dtype=np.uint8)
    if keep == "visible":
        table[[0x20, *range(0x09, 0x0E)]] = _SPACE
    elif keep == "alnum":
        ascii_word = np.array([chr(b).isalnum() for b in range(128)])
        table[:128][~ascii_word] = _SPACE
    else:
        raise ValueError(f"unknown word pattern: {keep}")
    if lower:
        table[ord("A") : ord("Z") + 1] += 32
    return table


VISIBLE = byte_map("visible", False)
VISIBLE_LOWER = byte_map("visible", True)
ALNUM_LOWER = byte_map("alnum", True)


@dataclass
class Raw:
    """The bytes of some texts: text i is data[offsets[i]:offsets[i+1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def raw(texts: pa.Array) -> Raw:
    """The bytes of a string array; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    n = len(texts)
    if not n:
        return Raw(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Raw(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(texts: pa.Array, limit: int = SLICE_BYTES, most: int | None = None) -> Iterator[tuple[int, int, Raw]]:
    """First row, end row and bytes of runs of texts, each of ``limit`` bytes or a single text, and of
    ``most`` texts where that is given."""
    whole = raw(texts)
    at = 0
    while at < len(whole):
        end = int(np.searchsorted(whole.offsets, whole.offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), len(whole), at + (most or len(whole)))
        part = whole.offsets[at : end + 1]
        yield at, end, Raw(whole.data[part[0] : part[-1]], part - part[0])
        at = end


@dataclass
class Words:
    """The words of some texts, one after the other; text i has words[first[i]:first[i+1]]."""

    data: np.ndarray  # bytes of all words, nothing between them
    offsets: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def array(self) -> pa.BinaryArray:
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(self), [None, pa.py_buffer(self.offsets.astype(np.int32)), pa.py_buffer(self.data)]
        )

    def coded(self) -> tuple[pa.BinaryArray, np.ndarray]:
        """The different words, and the place of each word among them."""
        coded = self.array().dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)


def words(texts: Raw, table: np.ndarray) -> Words:
    mapped = table[texts.data]
    inside = mapped != _SPACE
    # A text's last word ends with the text, so a word also starts where a text does.
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    before = np.zeros(len(mapped) + 1, np.int64)
    np.cumsum(inside, out=before[1:])
    return Words(
        mapped[inside],
        np.append(before[starts], before[-1]),
        np.searchsorted(starts, texts.offsets, "left"),
    )


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashes(values: pa.BinaryArray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte string, the same in every task: a polynomial over its bytes."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int32, n + 1, values.offset * 4).astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    length = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], length)
    powers = _powers(int(length.max(initial=0)) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[place], out=total[1:])
    return mix(total[offsets[1:]] - total[offsets[:-1]] + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def _powers(n: int) -> np.ndarray:
    base = np.full(n, np.uint64(0xD6E8FEB86659FD93))
    base[0] = 1
    return np.cumprod(base, dtype=np.uint64)


def shingle_hashes(word_hash: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each text, and each text's first one. A text with
    fewer words, but not none, has its whole sequence as one."""
    n = np.diff(first)
    runs = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    begin = np.zeros(len(n) + 1, np.int64)
    np.cumsum(runs, out=begin[1:])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1], runs) + np.repeat(first[:-1], runs)
    length = np.repeat(np.minimum(n, width), runs)
    out = length.astype(np.uint64)
    for k in range(width):
        held = np.flatnonzero(length > k)
        out[held] = mix(out[held] * np.uint64(0x9E3779B97F4A7C15) + word_hash[at[held] + k])
    return out, begin


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % divisor, F.lit(-1))
