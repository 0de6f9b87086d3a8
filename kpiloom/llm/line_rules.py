"""Line-first cleaning: rules judge each line, failing lines go, then documents that lost too much.

A line is what stands between two ``\\n``. A line without a word takes part in nothing. Rules, in
bytes and words of the one line:

* symbols: more than ``symbol_share`` symbol characters (``SYMBOLS``) per word;
* navigation: at least ``separators`` separators between words (``|``, ``>``, ``»``, ``·``, ``•``),
  and more than one per three words;
* shouting: at least three words, and over half of its words end in ``!!``;
* punctuation: no sentence end in the line at all, and fewer than ``short_line`` words;
* boilerplate: a licence, cookie, copyright or navigation phrase (``BOILERPLATE``) in a line of at most
  ``phrase_line`` words: in a long line, such as a text without line breaks, a phrase is no ground;
* repeated: equal to an earlier line of the document.

A document is kept if the lines that stay hold more than half of its words (``1 - max_lost``). The
document rules of the base (too short, too repetitive) reject it whatever its lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import text

SYMBOLS = b"#*$%&|<>"

#: Phrases of lines that are no content, matched without regard to ASCII case.
BOILERPLATE = (
    "licensed under the",
    "all rights reserved",
    "without warranties or conditions",
    "permission is hereby granted",
    "spdx-license-identifier",
    "terms of (use|service)",
    "privacy policy",
    "(use|uses|accept) (of )?cookies",
    "enable javascript",
    "lorem ipsum",
    "click here",
    "subscribe to our",
)


@dataclass(frozen=True)
class Rules:
    symbol_share: float = 0.1
    separators: int = 2
    short_line: int = 3
    phrase_line: int = 50
    max_lost: float = 0.5
    min_words: int = 10
    max_repeated_percent: int = 20
    repeat_window: int = 5


@dataclass
class Judged:
    """Figures of each text and verdicts of each line of a slice."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    kept_words: np.ndarray
    base_failed: np.ndarray
    kept: np.ndarray
    line_start: np.ndarray
    line_end: np.ndarray
    line_text: np.ndarray
    line_kept: np.ndarray


def _per(edges: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """How many of the counted bytes lie between neighbouring edges."""
    total = np.zeros(len(counted) + 1, np.int64)
    np.cumsum(counted, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def repeated_words(codes: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """For each text the words inside windows that it holds twice or more."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    starts = np.flatnonzero(np.arange(len(codes)) + window <= first[doc + 1])
    if not len(starts):
        return np.zeros(len(n), np.int64)
    key = doc[starts].astype(np.uint64)
    for k in range(window):
        key = text.mix(key * np.uint64(0x9E3779B97F4A7C15) + codes[starts + k].astype(np.uint64) + np.uint64(1))
    ordered = np.sort(key)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return np.zeros(len(n), np.int64)
    at = np.minimum(np.searchsorted(again, key), len(again) - 1)
    found = starts[again[at] == key]
    step = np.zeros(len(codes) + 1, np.int64)
    np.add.at(step, found, 1)
    np.add.at(step, found + window, -1)
    return _per(first, np.cumsum(step)[:-1] > 0)


def judge(texts: text.Raw, rules: Rules) -> Judged:
    data, docs = texts.data, len(texts)
    w = text.words(texts, text.VISIBLE)
    different, codes = w.coded()
    symbol = np.isin(data, np.frombuffer(SYMBOLS, np.uint8))

    # Lines: every text has one at least; a text's end ends its last line.
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([texts.offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([texts.offsets[1:], breaks]))
    line_text = np.sort(np.concatenate([np.arange(docs), np.searchsorted(texts.offsets, breaks, "right") - 1]))
    inside = text.VISIBLE[data] != 0x20
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    begins[edges] = inside[edges]
    count = _between(starts, ends)
    words = count(begins)
    real = words > 0

    bang = data == 0x21
    loud = np.zeros(len(data), bool)
    if len(data) > 1:
        last = np.append(~inside[1:], True)
        loud[1:] = bang[1:] & bang[:-1] & last[1:]
    separator = (data == ord("|")) | (data == ord(">"))
    for mark in ("»", "·"):  # two bytes each
        a, b = mark.encode()
        separator[:-1] |= (data[:-1] == a) & (data[1:] == b)
    separator[:-2] |= (data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (data[2:] == 0xA2)  # a bullet
    stop = np.isin(data, np.frombuffer(b".!?", np.uint8))
    separators = count(separator)
    failed = count(symbol) > rules.symbol_share * words
    failed |= (separators >= rules.separators) & (3 * separators > words)
    failed |= (words >= 3) & (2 * count(loud) > words)
    failed |= (count(stop) == 0) & (words < rules.short_line)
    lines = _strings(data, starts, ends)
    phrase = pc.match_substring_regex(lines, "|".join(BOILERPLATE), ignore_case=True).to_numpy(zero_copy_only=False)
    failed |= phrase & (words <= rules.phrase_line)
    repeated = _repeated(lines, line_text, real)
    failed |= repeated
    stays = real & ~failed

    n = w.counts
    by_text = lambda values: np.bincount(line_text, values, docs).astype(np.int64)
    repeat = repeated_words(codes, w.first, rules.repeat_window)
    base_failed = (n < rules.min_words) | (100 * repeat > rules.max_repeated_percent * n)
    kept_words = by_text(words * stays)
    return Judged(
        n_words=n,
        word_chars=_per(texts.offsets, inside & ((data & 0xC0) != 0x80)),
        n_symbols=_per(texts.offsets, symbol),
        n_dup_lines=by_text(repeated),
        n_repeat_words=repeat,
        kept_words=kept_words,
        base_failed=base_failed,
        kept=~base_failed & (kept_words > (1 - rules.max_lost) * n),
        line_start=starts,
        line_end=ends,
        line_text=line_text,
        line_kept=~(real & failed),
    )


def _between(starts: np.ndarray, ends: np.ndarray):
    def count(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[ends] - total[starts]

    return count


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """Lines as an array. Only line breaks lie between them, so the bytes without breaks do."""
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[data != 0x0A]))]
    )


def _repeated(lines: pa.BinaryArray, line_text: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    codes = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = line_text * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[order[1:]] = key[order[1:]] == key[order[:-1]]
    return same & real


COLUMNS = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "kept_words": "bigint",
    "base_failed": "boolean",
    "kept": "boolean",
}


def measure(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Figures and verdict of each row: ``doc_id`` and ``COLUMNS``.

    A null or empty text, and one of white space only, has no words and fails the base. Repeated
    rows are judged each; no column but doc_id and text is read.
    """
    params = asdict(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Rules(**params)
        for batch in batches:
            for a, b, part in text.slices(batch["text"]):
                judged = judge(part, own)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(a, b - a), *(pa.array(getattr(judged, c)) for c in COLUMNS)],
                    ["doc_id", *COLUMNS],
                )

    kinds = ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {kinds}"
    )


def cleaned(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that stay, all columns, their text reduced to the lines that stay. ``n_chars``,
    where there is one, follows the text."""
    params = asdict(rules)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Rules(**params)
        for batch in batches:
            for a, b, part in text.slices(batch["text"]):
                judged = judge(part, own)
                keep = np.flatnonzero(judged.kept)
                rows = batch.slice(a, b - a).take(pa.array(keep))
                texts = _join(part, judged, keep)
                columns = {name: rows[name] for name in names} | {"text": texts}
                if "n_chars" in names:
                    columns["n_chars"] = pc.utf8_length(texts).cast(batch.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.schema)


def _join(texts: text.Raw, judged: Judged, keep: np.ndarray) -> pa.Array:
    out = []
    stays = np.flatnonzero(judged.line_kept)
    first = np.searchsorted(judged.line_text[stays], np.arange(len(texts) + 1))
    buffer = texts.data.tobytes()
    for i in keep:
        own = stays[first[i] : first[i + 1]]
        out.append(b"\n".join(buffer[a:b] for a, b in zip(judged.line_start[own], judged.line_end[own], strict=True)))
    return pa.array(out, pa.binary()).cast(pa.string())
