"""Document scores by prediction by partial matching over bytes.

A text is the bytes of its lower-cased words with one space between them and an end byte behind. A
byte is predicted from the ``order`` bytes before it. If a context has seen n bytes, d of them
different, a byte seen c times gets c / (n + d); otherwise d / (n + d) is paid to escape to the
context shortened by one byte, where the bytes that the longer context has seen are excluded: they
neither take probability nor count in n and d. Below the empty context all bytes left are alike.

``pretrained`` scores with a trie counted over the training rows. What a longer context has seen, all
its shorter ones have seen too, so the excluded counts are a property of a context alone, and the
probability of a byte is one number for each string of order + 1 bytes. The trie is a table of those
strings, built level by level with joins. It is never gathered in one place: each slice of texts
asks for the strings and words it holds, the answers are joined to the requests, and a slice meets
its own answers. Requests of a slice are reduced to its different strings, so a hot one is a row for
each slice and not for each occurrence. The ``COMMON`` strings and words that most slices hold are
answered by broadcast instead: a bounded number of rows, which spares most of the answers' way.

``adaptive`` scores each text alone, with a trie that learns it byte by byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm import storage, text

ORDER = 5
END = 0x0A

#: Bytes of text that ask for their strings together.
SLICE_BYTES = 24 << 20
_CHUNK_BYTES = 2 << 20

#: Strings, and words, whose values are broadcast, and bits for a place in a slice.
COMMON = 1 << 18
_PLACE_BITS = 25


def stream(w: text.Words, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, ``order`` end bytes before each; the places that are predicted, and their
    texts."""
    length = np.diff(w.offsets)
    doc = w.text_of()
    n = np.bincount(doc, length, len(w.counts)).astype(np.int64) + np.maximum(w.counts, 1)
    begin = np.concatenate([[0], np.cumsum(n + order)])
    out = np.full(begin[-1], END, np.uint8)
    # A word starts behind the words and spaces before it in its text.
    before = w.offsets[:-1] + np.arange(len(length))
    base = before[np.minimum(w.first[:-1], max(len(length) - 1, 0))] if len(length) else np.zeros(len(n), np.int64)
    start = before - base[doc] + begin[doc] + order
    out[np.arange(len(w.data)) + np.repeat(start - w.offsets[:-1], length)] = w.data
    last = np.zeros(len(length), bool)
    last[w.first[1:][w.counts > 0] - 1] = True
    out[(start + length)[~last]] = 0x20
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[:-1] + order, n)
    return out, place, owner


def grams(w: text.Words, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The last order + 1 bytes up to each predicted one as a number, newest lowest; and its text."""
    out, place, owner = stream(w, order)
    code = out.astype(np.int64)
    for k in range(1, order + 1):
        code[k:] |= out[:-k].astype(np.int64) << 8 * k
    return code[place], owner


def _different(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int, text.Words]]:
    for a, b, part in text.slices(texts, _CHUNK_BYTES):
        yield a, b, text.words(part, text.VISIBLE_LOWER)


def _requests(rows: pa.RecordBatch, order: int, counted: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Strings and words of a slice, in a fixed order, and, where ``counted``, how often training texts
    hold them."""
    training = rows["training"].to_numpy(zero_copy_only=False)
    seen, learned, words, times = [], [], [], []
    for a, b, w in _chunks(rows["text"]):
        code, owner = grams(w, order)
        different, codes = w.coded()
        words.append(different)
        if not counted:
            seen.append(_different(code))
            continue
        # One sort serves both: the lowest bit says whether the string's text is a training one.
        code = np.sort(code << 1 | training[a:b][owner])
        own = code >> 1
        new = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
        seen.append(own[new])
        learned.append(np.add.reduceat(code & 1, new) if len(new) else new)
        times.append(np.bincount(codes[training[a:b][w.text_of()]], minlength=len(different)))
    all_grams = _different(np.concatenate([*seen, np.zeros(0, np.int64)]))
    counts = np.zeros(len(all_grams), np.int64)
    for own, n in zip(seen, learned, strict=counted):
        counts[np.searchsorted(all_grams, own)] += n
    coded = pa.concat_arrays([*words, pa.array([], pa.binary())]).dictionary_encode()
    if not counted:
        return all_grams, counts, coded.dictionary, np.zeros(0, np.int64)
    indices = coded.indices.to_numpy(zero_copy_only=False)
    total = np.bincount(indices, np.concatenate([*times, np.zeros(0)]), len(coded.dictionary)).astype(np.int64)
    return all_grams, counts, coded.dictionary, total


class _Slots:
    """Places of keys in a sorted array: a table of four slots a key holds the place of one key that
    falls on the slot; keys that are not that one are searched for."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(int(4 * len(keys) - 1).bit_length(), 1)
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, np.int32 if len(keys) < 1 << 31 else np.int64)
        self.table[self._slot(keys)] = np.arange(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(wanted), np.int64)
        at = self.table[self._slot(wanted)]
        other = np.flatnonzero(self.keys[at] != wanted)
        at[other] = np.searchsorted(self.keys, wanted[other])
        return at


_PACKED = "at bigint, gram bigint, word binary, n bigint, texts binary"


def _pack(docs: DataFrame, order: int) -> DataFrame:
    """Texts in compressed slices, and a row for each string and word that a slice asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ``at`` holds slice and place: one number, which varies little from row to row.
        names = ["at", "gram", "word", "n", "texts"]
        number = TaskContext.get().partitionId() << 16
        for batch in batches:
            for a, b, _ in text.slices(batch["text"], SLICE_BYTES):
                rows = batch.slice(a, b - a)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=9))) as out:
                    out.write_batch(rows)
                learning = int(np.count_nonzero(rows["training"].to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number << _PLACE_BITS], pa.int64()),
                        pa.nulls(1, pa.int64()),
                        pa.nulls(1, pa.binary()),
                        pa.array([learning], pa.int64()),
                        pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                    ],
                    names,
                )
                all_grams, counts, words, total = _requests(rows, order)
                for keys, n, kind in ((all_grams, counts, 1), (words, total, 2)):
                    for at in range(0, len(keys), 100_000):
                        own = keys[at : at + 100_000]
                        size = len(own)
                        columns = [
                            pa.array((number << _PLACE_BITS) + np.arange(at, at + size), pa.int64()),
                            pa.nulls(size, pa.int64()),
                            pa.nulls(size, pa.binary()),
                            pa.array(n[at : at + size], pa.int64()),
                            pa.nulls(size, pa.binary()),
                        ]
                        columns[kind] = pa.array(own, pa.int64()) if kind == 1 else own
                        yield pa.RecordBatch.from_arrays(columns, names)
                number += 1

    return docs.mapInArrow(run, _PACKED)


def trie(counts: DataFrame, order: int) -> DataFrame:
    """``gram`` and ``p``, the probability of its last byte after the others, from ``gram`` and ``n``.

    Level j holds strings of j + 1 bytes: n, the sums ``all`` and ``kinds`` of their context, and
    ``rest``, the probability of the byte once its context has been escaped from.
    """
    suffix = lambda column, size: F.col(column).bitwiseAND(F.lit((1 << 8 * size) - 1))
    context = Window.partitionBy(F.shiftright("gram", 8))
    seen = F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).over(context)
    below = None
    for j in range(order + 1):
        level = counts if j == order else counts.groupBy(suffix("gram", j + 1).alias("gram")).agg(F.sum("n").alias("n"))
        if below is None:
            level = level.withColumns({"all": F.sum("n").over(context), "kinds": seen})
            level = level.withColumn("rest", F.try_divide(F.lit(1), 256 - F.col("kinds")))
        else:
            lower = below.select(
                F.col("gram").alias("suffix"),
                F.col("n").alias("n_low"),
                F.col("all").alias("all_low"),
                F.col("kinds").alias("kinds_low"),
                F.col("rest").alias("rest_low"),
            )
            level = level.withColumn("suffix", suffix("gram", j)).join(lower, "suffix")
            excluded = F.sum(F.when(F.col("n") > 0, F.col("n_low")).otherwise(0)).over(context)
            level = level.withColumns({"all": F.sum("n").over(context), "kinds": seen, "excluded": excluded})
            new = F.col("kinds_low") - F.col("kinds")
            room = F.col("all_low") - F.col("excluded") + new
            rest = F.when(F.col("n_low") > 0, F.try_divide("n_low", room))
            rest = rest.when(room > 0, F.try_divide(new, room) * F.col("rest_low")).otherwise(F.col("rest_low"))
            level = level.withColumn("rest", rest).select("gram", "n", "all", "kinds", "rest")
        below = storage.written(level, "trie") if j < order else level
    total = F.col("all") + F.col("kinds")
    p = F.when(F.col("n") > 0, F.try_divide("n", total))
    p = p.when(F.col("all") > 0, F.try_divide("kinds", total) * F.col("rest")).otherwise(F.col("rest"))
    return below.select("gram", p.alias("p"))


_SCORED = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def pretrained(docs: DataFrame, training: Column, order: int = ORDER) -> DataFrame:
    """For each row ``doc_id``, ``training``, and ``n_tokens`` (words and one end), ``n_known`` (those
    seen in training), ``train_tokens``, ``base_score`` (add-one word counts) and ``score`` (the
    model), both log10 probabilities of the whole text.

    ``training``, a condition on doc_id, tells the rows that are counted; null is false. A null or
    empty text is one end. Repeated rows are counted and scored each. Without training rows every
    byte has probability 1/256. Only doc_id and text are read.
    """
    source = docs.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(training, F.lit(False)).alias("training")
    )
    packed = storage.written(_pack(source, order), "packed")
    asked = {kind: packed.filter(F.col(kind).isNotNull()) for kind in ("gram", "word")}
    # Each different string and word once, with its count over all training texts.
    known = {
        kind: storage.written(rows.groupBy(kind).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("slices")), kind)
        for kind, rows in asked.items()
    }
    ends = packed.filter(F.col("texts").isNotNull()).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total, different = known["word"].agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    total, different = total + ends, different + (ends > 0)
    values = {
        "gram": storage.written(trie(known["gram"], order).select("gram", F.log10("p").alias("value")), "values"),
        "word": known["word"].select("word", F.col("n").cast("double").alias("value")),
    }
    common, answers = {}, []
    for kind in asked:
        widest = known[kind].filter("slices > 1").orderBy(F.desc("slices"), kind).limit(COMMON).select(kind)
        # At most COMMON rows are broadcast and gathered.
        widest = storage.written(widest, "common")
        table = values[kind].join(F.broadcast(widest), kind).orderBy(kind).toArrow()
        common[kind] = (table[kind].combine_chunks(), table["value"].to_numpy())
        rest = asked[kind].select(kind, "at").join(F.broadcast(widest), kind, "left_anti").join(values[kind], kind)
        answers.append(_bundled(rest.select("at", F.lit(kind == "word").alias("is_word"), "value")))
    shipped = docs.sparkSession.sparkContext.broadcast(common)
    texts = packed.filter(F.col("texts").isNotNull()).select(F.shiftright("at", _PLACE_BITS).alias("of"), "texts")
    kind = source.schema["doc_id"].dataType.simpleString()

    def score(slices: pa.Table, answers: pa.Table) -> pa.Table:
        found = {True: ([], []), False: ([], [])}
        for is_word, bundle in zip(answers["is_word"].to_pylist(), answers["bundle"].to_pylist(), strict=True):
            rows = pa.ipc.open_stream(bundle).read_all()
            found[is_word][0].append(rows["place"].to_numpy())
            found[is_word][1].append(rows["value"].to_numpy())
        place, value = zip(*(tuple(np.concatenate([*x, np.zeros(0)]) for x in found[k]) for k in (False, True)), strict=True)
        out = []
        for packed_texts in slices["texts"].to_pylist():
            rows = pa.ipc.open_stream(packed_texts).read_all().combine_chunks().to_batches()[0]
            out.append(_score(rows, order, shipped.value, place, value, ends, total, different))
        return pa.concat_tables(out)

    return (
        texts.groupBy("of")
        .cogroup(answers[0].unionByName(answers[1]).groupBy("slice"))
        .applyInArrow(score, f"doc_id {kind}, training boolean, {_SCORED}")
    )


def _bundled(answers: DataFrame) -> DataFrame:
    """Answers for one slice from one task as one compressed row. Rows are put in order first, so
    those of a slice follow each other; a bundle has a bounded number of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch["at"].to_numpy()
            number, place = at >> _PLACE_BITS, (at & ((1 << _PLACE_BITS) - 1)).astype(np.int32)
            cuts = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(at))
            values, kinds = batch["value"], batch["is_word"]
            slices, bundles = [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                rows = pa.RecordBatch.from_arrays([pa.array(place[a:b]), values.slice(a, b - a)], ["place", "value"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(rows)
                slices.append(int(number[a]))
                bundles.append(sink.getvalue().to_pybytes())
            if slices:
                flags = kinds.take(pa.array(cuts[:-1]))
                yield pa.RecordBatch.from_arrays([pa.array(slices), flags, pa.array(bundles, pa.binary())], ["slice", "is_word", "bundle"])

    ordered = answers.sortWithinPartitions("at")
    return ordered.mapInArrow(run, "slice bigint, is_word boolean, bundle binary")


def _looked_up(keys, common: tuple, places: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each key of a slice: from the common ones, or from its answers by place."""
    out = np.zeros(len(keys))
    held, held_values = common
    if len(held):
        at = _place(held, keys if isinstance(keys, pa.Array) else pa.array(keys, pa.int64()))
        known = at >= 0
        out[known] = held_values[at[known]]
    out[places.astype(np.int64)] = values
    return out


def _score(rows: pa.RecordBatch, order: int, common, place, value, ends: int, total: int, different: int) -> pa.Table:
    all_grams, _, words, _ = _requests(rows, order, counted=False)
    slots = _Slots(all_grams)
    gram_value = _looked_up(all_grams, common["gram"], place[0], value[0])
    word_count = _looked_up(words, common["word"], place[1], value[1])
    n = rows.num_rows
    tokens, known, base, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    room = total + different + 1
    for a, b, w in _chunks(rows["text"]):
        code, owner = grams(w, order)
        score[a:b] = np.bincount(owner, gram_value[slots.find(code)], b - a)
        own, codes = w.coded()
        doc, count = w.text_of(), word_count[_place(words, own)[codes]]
        tokens[a:b] = w.counts + 1
        known[a:b] = np.bincount(doc, count > 0, b - a) + (ends > 0)
        base[a:b] = np.bincount(doc, np.log10((count + 1) / room), b - a) + math.log10((ends + 1) / room)
    columns = {
        "doc_id": rows["doc_id"],
        "training": rows["training"],
        "n_tokens": tokens,
        "n_known": known,
        "train_tokens": np.full(n, total, np.int64),
        "base_score": base,
        "score": score,
    }
    return pa.table(columns)


def _place(values: pa.Array, wanted: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.index_in(wanted, value_set=values).fill_null(-1).to_numpy(zero_copy_only=False)


class Trie:
    """Counts of bytes after contexts, for one text at a time."""

    def __init__(self, order: int = ORDER):
        self.order = order
        self.seen: dict[bytes, dict[int, int]] = {}

    def probability(self, before: bytes, byte: int) -> float:
        p, excluded = 1.0, set()
        for size in range(min(self.order, len(before)), -1, -1):
            counts = self.seen.get(before[len(before) - size :], {})
            left = {s: c for s, c in counts.items() if s not in excluded}
            total = sum(left.values()) + len(left)
            if byte in left:
                return p * left[byte] / total
            if left:
                p *= len(left) / total
            excluded |= set(counts)
        return p / (256 - len(excluded))

    def learn(self, before: bytes, byte: int) -> None:
        for size in range(min(self.order, len(before)) + 1):
            counts = self.seen.setdefault(before[len(before) - size :], {})
            counts[byte] = counts.get(byte, 0) + 1


def adaptive(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``doc_id`` and ``score``, the log10 probability of each text under a trie that has seen only
    what stands before in it. Null and empty texts are one end byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for a, b, w in _chunks(batch["text"]):
                out, place, owner = stream(w, order)
                data = out.tobytes()
                totals = np.zeros(b - a)
                model, now = None, -1
                for at, doc in zip(place.tolist(), owner.tolist(), strict=True):
                    if doc != now:
                        model, now = Trie(order), doc
                    before = data[at - order : at]
                    totals[doc] += math.log10(model.probability(before, data[at]))
                    model.learn(before, data[at])
                scores.append(totals)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.concatenate([*scores, np.zeros(0)]))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
