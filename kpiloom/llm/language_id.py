"""Language identification of whole and of mixed texts.

Each word gets a score for every learned language: the log probability of its byte trigrams, counted
over all training texts. The script of its letters narrows the candidates first: a language is one
if at least ``SCRIPT_SHARE`` of its training letters have this script (if none is, all are). A
Viterbi pass over the words of a text, in which a change of language costs ``SWITCH``, labels spans;
the text's language is that of most letters.

The model has ``BUCKETS`` counts for each language, and at most ``MAX_LANGUAGES`` languages.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import text

BUCKETS = 1 << 15
MAX_LANGUAGES = 256
SWITCH = 8.0
SCRIPT_SHARE = 0.01
SMOOTHING = 0.5
UNKNOWN = "und"

#: First and last code point of the blocks of each script.
SCRIPTS = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
OTHER = len(SCRIPTS)
_LAST = 0x323AF


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket x language
    allowed: np.ndarray  # script x language


def script_table() -> np.ndarray:
    """For each code point the number of its script if it is a letter, else -1."""
    letters = np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x20000)])
    table = np.full(_LAST + 1, -1, np.int8)
    table[: len(letters)][letters] = OTHER
    table[0x20000:] = OTHER
    for number, blocks in enumerate(SCRIPTS.values()):
        for a, b in blocks:
            own = table[a : b + 1]
            own[own >= 0] = number
    return table


def _code_points(part: text.Raw) -> tuple[np.ndarray, np.ndarray]:
    """Code point and word of each character of the words."""
    data = part.data.astype(np.int64)
    heads = np.flatnonzero((part.data & 0xC0) != 0x80)
    size = np.diff(np.append(heads, len(data)))
    lead = data[heads]
    point = np.where(lead < 0x80, lead, np.where(lead < 0xE0, lead & 0x1F, np.where(lead < 0xF0, lead & 0x0F, lead & 0x07)))
    for k in (1, 2, 3):
        longer = size > k
        point[longer] = point[longer] << 6 | data[heads[longer] + k] & 0x3F
    return point, np.searchsorted(part.offsets, heads, "right") - 1


def scripts_of(different: text.Raw, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each word, and the script of most of them (-1 without letters)."""
    point, word = _code_points(different)
    kind = np.where(point <= _LAST, table[np.minimum(point, _LAST)], -1)
    held = kind >= 0
    counts = np.bincount(word[held] * (OTHER + 1) + kind[held], minlength=len(different) * (OTHER + 1))
    counts = counts.reshape(len(different), OTHER + 1)
    letters = counts.sum(1)
    return letters, np.where(letters > 0, counts.argmax(1), -1)


def trigrams(different: text.Raw) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of each word with a space on either side, and each word's first."""
    length = np.diff(different.offsets)
    offsets = different.offsets + 2 * np.arange(len(length) + 1)
    data = np.full(offsets[-1], 0x20, np.uint32)
    inner = np.arange(len(different.data)) + np.repeat(2 * np.arange(len(length)) + 1, length)
    data[inner] = different.data
    at = inner - 1
    code = data[at] << np.uint32(16) | data[at + 1] << np.uint32(8) | data[at + 2]
    return (code * np.uint32(0x9E3779B1) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64), different.offsets


def _words(part: text.Raw) -> tuple[text.Words, np.ndarray, text.Raw]:
    w = text.words(part, text.ALNUM_LOWER)
    different, codes = w.coded()
    return w, codes, text.raw(different)


def fit(docs: DataFrame, training: Column, lang: str = "lang") -> Model:
    """Counts over all rows for which ``training``, a condition on doc_id, holds and that have text
    and language."""
    rows = docs.filter(training).select(F.col(lang).cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = script_table()
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for a, b, part in text.slices(batch["text"]):
                w, codes, different = _words(part)
                names = batch["lang"].slice(a, b - a).dictionary_encode()
                own = names.indices.to_numpy(zero_copy_only=False)[w.text_of()] if len(w) else np.zeros(0, int)
                bucket, first = trigrams(different)
                word = np.repeat(np.arange(len(different)), np.diff(first))
                letters, script = scripts_of(different, table)
                for k, name in enumerate(names.dictionary.to_pylist()):
                    times = np.bincount(codes[own == k], minlength=len(different))
                    counts = total.setdefault(name, np.zeros(BUCKETS + OTHER + 1))
                    counts[:BUCKETS] += np.bincount(bucket, times[word], BUCKETS)
                    seen = script >= 0
                    counts[BUCKETS:] += np.bincount(script[seen], (times * letters)[seen], OTHER + 1)
        for name, counts in total.items():
            held = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(held), pa.string()), pa.array(held, pa.int32()), pa.array(counts[held].astype(np.int64))],
                ["lang", "bucket", "n"],
            )

    counted = rows.dropna().mapInArrow(run, "lang string, bucket int, n bigint")
    counted = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # The smallest names are taken to see whether there are too many; the counts are then bounded.
    names = [r["lang"] for r in rows.dropna().select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found = counted.toArrow()
    place = {name: i for i, name in enumerate(names)}
    counts = np.zeros((BUCKETS + OTHER + 1, len(names)))
    column = np.array([place[x] for x in found["lang"].to_pylist()], int)
    counts[found["bucket"].to_numpy(), column] = found["n"].to_numpy()
    grams, letters = counts[:BUCKETS], counts[BUCKETS:]
    scores = np.log((grams + SMOOTHING) / (grams.sum(0) + SMOOTHING * BUCKETS)).astype(np.float32)
    return Model(names, scores, letters > SCRIPT_SHARE * np.maximum(letters.sum(0), 1))


def word_scores(model: dict, different: text.Raw, script: np.ndarray) -> np.ndarray:
    """Word x language: log probabilities; none for languages that the script rules out, and all
    alike for words without letters."""
    bucket, first = trigrams(different)
    n, kinds = len(different), len(model["languages"])
    out = np.zeros((n, kinds), np.float32)
    rows = max(1, (1 << 24) // kinds)
    at = 0
    while at < n:
        end = int(np.searchsorted(first, first[at] + rows, "right")) - 1
        end = min(max(end, at + 1), n)
        gain = model["scores"][bucket[first[at] : first[end]]]
        out[at:end] = np.add.reduceat(gain, first[at:end] - first[at], axis=0)  # words are never empty
        at = end
    allowed = model["allowed"][np.maximum(script, 0)]
    allowed[~allowed.any(1)] = True
    out[~allowed] = -1e6
    out[script < 0] = 0
    return out


def viterbi(scores: np.ndarray, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best language of each word: all texts go forward together, word by word."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    ordered = n[order]
    kinds = scores.shape[1]
    back = np.zeros((len(codes), kinds), np.uint8 if kinds <= 256 else np.uint16)
    best = np.zeros((len(n), kinds), np.float64)
    active = np.searchsorted(-ordered, -np.arange(1, int(ordered.max(initial=0)) + 1), "right")
    own = np.arange(kinds)
    for t, m in enumerate(active):
        at = first[order[:m]] + t
        if t:
            now = best[:m]
            top = now.argmax(1)
            change = now[np.arange(m), top][:, None] - SWITCH
            stay = now >= change
            back[at] = np.where(stay, own, top[:, None])
            best[:m] = np.maximum(now, change)
        best[:m] += scores[codes[at]]
    label = np.zeros(len(codes), np.int64)
    state = best.argmax(1) if len(best) and kinds else np.zeros(len(n), int)
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = first[order[:m]] + t
        label[at] = state[:m]
        state[:m] = back[at, state[:m]]
    return label


_SPANS = "array<struct<start: int, end: int, lang: string>>"


def label(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (the share of letters in spans of that language) and
    ``spans`` (runs of words: first, behind the last, language) for each row.

    A null text, or one without a letter, is ``und`` with score 0, and so are all rows if nothing
    was learned. Of languages with equally many letters the first by name wins. Only doc_id and text
    are read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vars(model))
    limit = text.SLICE_BYTES * 4 // max(4, len(model.languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = shipped.value, script_table()
        names = np.array(own["languages"], dtype=object)
        for batch in batches:
            for a, b, part in text.slices(batch["text"], limit):
                n, kinds = b - a, len(names)
                w, codes, different = _words(part)
                letters, script = scripts_of(different, table)
                if kinds and len(w):
                    labels = viterbi(word_scores(own, different, script), codes, w.first)
                else:
                    labels = np.zeros(len(w), int)
                doc = w.text_of()
                by_language = np.bincount(doc * max(kinds, 1) + labels, letters[codes], n * max(kinds, 1))
                by_language = by_language.reshape(n, max(kinds, 1))
                total = by_language.sum(1)
                known = (total > 0) & (kinds > 0)
                top = by_language.argmax(1)
                share = by_language[np.arange(n), top] / np.maximum(total, 1)
                predicted = np.full(n, UNKNOWN, dtype=object)
                predicted[known] = names[top[known]] if kinds else UNKNOWN
                new = np.append(True, (doc[1:] != doc[:-1]) | (labels[1:] != labels[:-1])) if len(w) else np.zeros(0, bool)
                starts = np.flatnonzero(new & known[doc]) if len(w) else np.zeros(0, int)
                runs = np.flatnonzero(new)
                ends = np.append(runs[1:], len(w))[np.searchsorted(runs, starts)]
                begin = w.first[doc[starts]]
                spans = pa.StructArray.from_arrays(
                    [
                        pa.array(starts - begin, pa.int32()),
                        pa.array(ends - begin, pa.int32()),
                        pa.array(names[labels[starts]] if kinds else [], pa.string()),
                    ],
                    ["start", "end", "lang"],
                )
                offsets = np.searchsorted(doc[starts], np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(a, n),
                        pa.array(predicted, pa.string()),
                        pa.array(np.where(known, share, 0.0)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
                    ],
                    ["doc_id", "lang_pred", "score", "spans"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, spans {_SPANS}"
    )
