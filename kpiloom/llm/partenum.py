"""Similarity join on sets of word shingles with PartEnum signatures, exact at its threshold.

Sets are linked if the Jaccard similarity of their shingles is ``percent`` or more. Linked sets r, s
with |r| <= |s| have |s| <= 100/percent |r|, and at most k = |r| (100 - percent) / percent elements
in which they differ. So each set signs for its own size band and for the bands below that a linked
smaller set may lie in. For a band, the domain of shingle hashes is cut into equal ranges: n1 groups
of ``PARTS`` parts, n1 so large that some group holds at most ``SPARE`` of the k differences. Each
way to leave out ``SPARE`` parts of a group gives one signature, a hash of the elements in the
others: linked sets share one.

A signature of no element, or of widespread ones only (shingles of lines that many texts share), tells
little: it is weak. Bands of several groups have s groups more than needed, so linked sets agree in
s + 1 groups at least. A set with at most s groups that have a weak signature may therefore leave its
weak ones out: one of the others is shared too. A set with more of them gives all, and so does any
set that agrees with it in weak ones only. Which shingles count as widespread changes the work, never
the links.

Equal sets are found before anything signs: a text signs if its id is the smallest of its copies. So the
signatures, and the edges they give, grow with the different texts, however often each is repeated.

What shares a signature is a candidate. Candidates are gathered into clusters by their connection
alone: equal keys are reduced to a star around their smallest document, first within each task's
slice of texts, so that a hot key leaves a task once. The keys of a slice travel as one sorted array for
each range of keys, cut to so many bits that a chance agreement is rare; what agrees by chance is one
more candidate. Then the texts of each cluster are compared exactly; a bitmap of the ids in clusters keeps
the other texts out of that shuffle. From a cluster beyond one block's size, texts first go of whose shingles too few occur in any
other of its texts, widespread ones taken as shared: they can have no link. The rest is cut into blocks that are compared two by two in tasks
of their own; its members close to its most typical one are linked to that one first, and blocks of
such members need no comparison with each other. Tasks return a spanning forest of the links, never
the pairs. Components follow from copies (equal sets) and links.

Shingles are 50-bit hashes; all counts are of those.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import graph, marks, packing, storage, text

#: Parts of a group, and how many of them a signature leaves out.
PARTS, SPARE = 3, 1

#: Size bands grow by this factor.
BAND = 1.25

#: One group more than needed for so many groups.
EXTRA = 8

#: A widespread shingle is in so many texts of a slice, and of all slices; at most so many are told.
HOT_IN_SLICE, HOT_TEXTS, MAX_HOT = 8, 32, 100_000

#: Documents and shingles compared in one block.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 150_000

#: Signatures in one range of keys, and bits of a signature beyond those that tell all of them apart.
RANGE_KEYS, SPARE_BITS = 1 << 20, 22
#: Ranges that a task takes in turn, and edges it holds to give each once.
TASK_RANGES, HELD_EDGES = 8, 1 << 20

#: Bytes of text signed at once: signatures take many times the memory of their text.
SIGNED_BYTES = 4 << 20

#: Rows of one cluster are dealt to so many tasks where they meet what is known of the cluster.
SALTS = 32

#: Bits of a text's number within its slice, and how many texts a slice may have for that.
_DOC_BITS = 14
MOST_TEXTS = 1 << _DOC_BITS
#: Kinds of rows: of what is known of a slice, and of signatures and the edges a slice has found already.
_DOC, _COPY, _COPY_IN_SLICE, _SHINGLE = 0, 1, 2, 3
_SIGNATURE, _EDGE = 0, 1


def band_starts(largest: int) -> np.ndarray:
    """Smallest size of each band, up to the band that follows ``largest``."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND)))
    return np.array(starts, np.int64)


def shingle_sets(texts: text.Raw, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, in order within each text, and each text's first."""
    if len(texts) > MOST_TEXTS:
        raise ValueError(f"{len(texts)} texts in one slice, at most {MOST_TEXTS} can be told apart")
    w = text.words(texts, text.VISIBLE_LOWER)
    different, codes = w.coded()
    hashed, first = text.shingle_hashes(text.hashes(different)[codes], w.first, width)
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(first))
    key = np.sort(doc << np.uint64(64 - _DOC_BITS) | hashed >> np.uint64(_DOC_BITS))
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    first = np.searchsorted(key >> np.uint64(64 - _DOC_BITS), np.arange(len(texts) + 1, dtype=np.uint64))
    return key & np.uint64((1 << 64 - _DOC_BITS) - 1), first


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _layout(size: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """For each set and each band it signs for: the set, the band, parts of a group, groups, and how many
    of these are more than needed."""
    starts = band_starts(int(size.max(initial=0)))
    band = np.searchsorted(starts, size, "right") - 1
    lowest = np.searchsorted(starts, -(-size * percent // 100), "right") - 1
    owner = np.repeat(np.arange(len(size)), np.where(size > 0, band - lowest + 1, 0))
    ordinal = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
    tag = lowest[owner] + ordinal
    k = (starts[tag + 1] - 1) * (100 - percent) // percent
    spare = np.minimum(SPARE, k)
    parts = np.where(spare > 0, PARTS, 1)
    groups = k // (spare + 1) + 1
    extra = np.where(groups >= 3, np.maximum(groups // EXTRA, 1), 0)
    return owner, tag, parts, groups + extra, extra


def signature_count(size: np.ndarray, percent: int) -> np.ndarray:
    """How many signatures each set of these sizes has at most."""
    owner, _, parts, groups, _ = _layout(size, percent)
    return np.bincount(owner, groups * np.where(parts > 1, comb(PARTS, SPARE), 1), len(size)).astype(np.int64)


def signatures(
    sets: np.ndarray, first: np.ndarray, percent: int, hot: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all non-empty sets, and the set of each key; ``hot`` has the widespread shingles."""
    size = np.diff(first)
    owner, tag, parts, groups, extra = _layout(size, percent)
    if not len(owner):
        return np.zeros(0, np.uint64), owner

    # All elements once for each tag of their set, and the part each falls into.
    n = size[owner]
    element = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[:-1][owner], n)
    value = sets[element]
    cells = groups * parts
    base = np.cumsum(cells) - cells
    width = np.uint64(64 - _DOC_BITS - 32)
    cell = np.repeat(base, n) + ((value >> width) * np.repeat(cells, n).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    edges = np.searchsorted(cell, np.arange(cells.sum() + 1))
    content = _sums(text.mix(value + np.uint64(1)), edges)
    telling = np.ones(len(value), bool)
    if hot is not None and len(hot):
        telling = hot[np.minimum(np.searchsorted(hot, value), len(hot) - 1)] != value
    telling = np.diff(np.concatenate([[0], np.cumsum(telling)])[edges])

    keys, owners, weak = [], [], []
    for used, left_out in ((1, 0), (PARTS, SPARE)):
        own = np.flatnonzero(parts == used)
        if not len(own):
            continue
        many = groups[own]
        group = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        row = np.repeat(own, many)
        at = base[row] + group * used
        choices = list(combinations(range(used), used - left_out))
        weak_here = np.stack([sum(telling[at + p] for p in kept) == 0 for kept in choices])
        weak_groups = np.bincount(row, weak_here.any(0), len(owner))
        droppable = (weak_groups <= extra)[row]
        for kept, is_weak in zip(choices, weak_here, strict=True):
            total = np.zeros(len(at), np.uint64)
            for p in kept:
                total += text.mix(content[at + p] + np.uint64(p))
            weak.append(is_weak & droppable & (extra[row] > 0))
            mark = (tag[row].astype(np.uint64) << np.uint64(40)) + group.astype(np.uint64) * np.uint64(64)
            keys.append(text.mix(total + text.mix(mark + np.uint64(sum(1 << p for p in kept)))))
            owners.append(owner[row])
        if PARTS == 1:
            break
    kept = ~np.concatenate(weak)
    return np.concatenate(keys)[kept], np.concatenate(owners)[kept]


def _read(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """What is known of the texts before they sign, a few rows for each slice (one scan, written): often
    used shingles, sizes, copies within the slice, and the keys of its different texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in text.slices(batch["text"], most=MOST_TEXTS):
                ids = batch["doc_id"].slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
                sets, first = shingle_sets(part, width)
                size = np.diff(first)
                whole = _sums(text.mix(sets + np.uint64(2)), first)
                new = np.zeros(len(whole), bool)
                new[np.unique(whole, return_index=True)[1]] = True  # copies count once
                ordered = np.sort(sets[np.repeat(new, size)])
                at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, int)
                times = np.diff(np.append(at, len(ordered)))
                often = times >= HOT_IN_SLICE
                yield _noted(_SHINGLE, shingle=ordered[at[often]].astype(np.int64), texts=times[often])

                second = _sums(text.mix(sets * np.uint64(0x9E3779B97F4A7C15)), first)
                key = text.mix(whole + size.astype(np.uint64))
                full = np.flatnonzero(size > 0)
                # Copies within the slice: the smallest id stands for all.
                both = text.mix(key + text.mix(second))
                order = full[np.lexsort((ids[full], both[full]))]
                new = np.append(True, both[order][1:] != both[order][:-1]) if len(order) else np.zeros(0, bool)
                stands = order[new]
                leader = ids[stands][np.cumsum(new) - 1][~new]
                copy = ids[order[~new]]
                order = np.argsort(ids)
                yield _noted(_DOC, packing.packed(ids[order], size[order]))
                order = np.argsort(leader)
                yield _noted(_COPY_IN_SLICE, packing.packed(leader[order], copy[order]))
                stands = stands[np.argsort(key[stands])]
                columns = (second[stands].view(np.int64), ids[stands], signature_count(size, percent)[stands])
                yield _noted(_COPY, packing.packed(key[stands].view(np.int64), *columns))

    return storage.written(docs.mapInArrow(run, "kind tinyint, shingle bigint, texts bigint, body binary"), "texts")


def _noted(kind: int, body: bytes | None = None, shingle: np.ndarray | None = None, texts: np.ndarray | None = None) -> pa.RecordBatch:
    n = 1 if shingle is None else len(shingle)
    columns = [pa.array(np.full(n, kind, np.int8))]
    columns += [pa.nulls(n, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in (shingle, texts)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([body] * n, pa.binary())], ["kind", "shingle", "texts", "body"])


def _unpacked(read: DataFrame, kind: int, *names: str) -> DataFrame:
    """The packed rows of a kind, as columns of these names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch["body"]:
                columns = packing.unpacked(body.as_py(), len(names))
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], list(names))

    packed = read.filter(F.col("kind") == kind).select("body")
    return packed.mapInArrow(run, ", ".join(f"{name} bigint" for name in names))


def _widespread(read: DataFrame) -> np.ndarray:
    """The shingles that the most different texts share, in order."""
    counts = read.filter(F.col("kind") == _SHINGLE).groupBy("shingle").agg(F.sum("texts").alias("texts"))
    top = counts.filter(F.col("texts") >= HOT_TEXTS).orderBy(F.desc("texts"), "shingle").limit(MAX_HOT).toArrow()
    return np.sort(top["shingle"].to_numpy()).astype(np.uint64)


def _copies(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges from the smallest id of equal sets, first within a slice, and the different sets: ``id``, the
    smallest of each, and ``signed``, its signatures at most."""
    found = _unpacked(read, _COPY, "key", "second", "id", "signed")
    alike = found.groupBy("key", "second").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.max("signed").alias("signed"))
    alike = storage.written(alike, "alike")
    again = found.join(alike.filter("low < high").select("key", "second", F.col("low").alias("a")), ["key", "second"])
    again = again.filter("id != a").select("a", F.col("id").alias("b"))
    copies = _unpacked(read, _COPY_IN_SLICE, "a", "b").filter("a != b").unionByName(again)
    return storage.written(copies, "copies"), alike.select(F.col("low").alias("id"), "signed")


def _spared(copies: DataFrame, different: DataFrame) -> tuple:
    """Two bitmaps: of the ids of copies alone, which need not sign, and of the other ids that the first one
    marks too. A text marked in the first only has an equal one that signs; a few copies sign as well."""
    standing = different.select("id").distinct()
    gone = storage.written(copies.select(F.col("b").alias("id")).distinct().join(standing, "id", "left_anti"), "gone")
    may_be_gone = marks.marked(gone)
    missed = storage.written(standing.filter(may_be_gone(F.col("id"))), "missed")
    return marks.bitmap(gone), marks.bitmap(missed, like=gone.count())


def _stars(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows left after equal keys are reduced to their smallest node, and the edges that stand for
    the rows taken away."""
    ordered = np.sort(key)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return np.ones(len(key), bool), node[:0], node[:0]
    at = np.minimum(np.searchsorted(again, key), len(again) - 1)
    rows = np.flatnonzero(again[at] == key)
    rows = rows[np.lexsort((node[rows], key[rows]))]
    new = np.append(True, key[rows][1:] != key[rows][:-1])
    leader = node[rows[new]][np.cumsum(new) - 1]
    keep = np.ones(len(key), bool)
    keep[rows[~new]] = False
    a, b = leader[~new], node[rows[~new]]
    return keep, *_different(a, b)


def _different(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = a[a != b], b[a != b]
    if not len(a):
        return a, b
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    return a[new], b[new]


_SIGNED = "part int, kind tinyint, body binary"
_EDGES = "a bigint, b bigint"


def _rows(names: list[str], *parts: tuple) -> pa.RecordBatch:
    columns = [np.concatenate([np.broadcast_to(p[i], len(p[-1])) for p in parts]) for i in range(len(names))]
    kinds = [np.int8 if name == "kind" else np.int64 for name in names]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(columns, kinds, strict=True)], names)


def _ranges(key: np.ndarray, parts: int) -> np.ndarray:
    """The range that each key falls into."""
    return ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _packed(kind: int, key: np.ndarray, ids: np.ndarray, parts: int, bits: int) -> list[tuple]:
    """Rows of part, kind and body: the keys of each range in order, cut to ``bits``, and their ids."""
    order = np.argsort(key)
    key, ids = key[order], ids[order]
    part = _ranges(key, parts)
    edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(key) else np.zeros(0, np.int64)
    key = key >> np.uint64(64 - bits)
    out = []
    for a, b in zip(edges, np.append(edges[1:], len(key)), strict=True):
        out.append((int(part[a]), kind, packing.packed(key[a:b].view(np.int64), ids[a:b])))
    return out


def _signed(docs: DataFrame, spared: tuple, width: int, percent: int, hot, parts: int, bits: int) -> DataFrame:
    """The signatures of each text that is not ``spared``, reduced within a slice."""
    (gone_at, gone), (missed_at, missed) = spared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Here and not by a filter before: that would take a second Python worker for each task.
            signs = ~marks.found(gone.value, batch["gone_at"]) | marks.found(missed.value, batch["missed_at"])
            batch = batch.filter(pa.array(signs))
            for a, b, part in text.slices(batch["text"], SIGNED_BYTES, MOST_TEXTS):
                ids = batch["doc_id"].slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
                signed, owner = signatures(*shingle_sets(part, width), percent, hot.value)
                keep, x, y = _stars(signed >> np.uint64(64 - bits), ids[owner])
                # Edges found already only pass through, in any one task.
                at = int(_ranges(text.mix(ids[:1].astype(np.uint64)), parts)[0])
                order = np.argsort(x)
                rows = [(at, _EDGE, packing.packed(x[order], y[order]))]
                rows += _packed(_SIGNATURE, signed[keep], ids[owner][keep], parts, bits)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int8(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "kind", "body"])

    own = F.col("doc_id")
    return docs.select("doc_id", "text", gone_at(own).alias("gone_at"), missed_at(own).alias("missed_at")).mapInArrow(run, _SIGNED)


def _edges(signed: DataFrame, parts: int, tasks: int) -> DataFrame:
    """A star of edges for each key. A task takes a run of ranges, one range of keys at a time, and gives a
    pair found in several of them once (``HELD_EDGES`` are held)."""

    def stars(candidates: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not candidates:
            return (np.zeros(0, np.int64),) * 2
        key, doc = (np.concatenate(c) for c in zip(*(packing.unpacked(c, 2) for c in candidates), strict=True))
        return _stars(key, doc.view(np.int64))[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        candidates, now = [], None
        low, high = np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = pa.RecordBatch.from_arrays([pa.array([t], k) for t, k in ((-1, pa.int32()), (_SIGNATURE, pa.int8()), (b"", pa.binary()))], ["part", "kind", "body"])
        for batch in chain(batches, [ends]):  # the last row ends the last range
            for part, kind, body in zip(batch["part"].to_pylist(), batch["kind"].to_pylist(), batch["body"], strict=True):
                if part != now:
                    near = stars(candidates)
                    candidates, now = [], part
                    low, high = _different(np.concatenate([low, near[0]]), np.concatenate([high, near[1]]))
                    if len(low) > HELD_EDGES or part < 0:
                        yield _rows(["a", "b"], (low, high))
                        low, high = low[:0], high[:0]
                if part < 0:
                    break
                if kind == _SIGNATURE:
                    candidates.append(body.as_py())
                    continue
                a, b = (c.view(np.int64) for c in packing.unpacked(body.as_py(), 2))
                if len(a):
                    yield _rows(["a", "b"], (a, b))

    task = F.floor(F.col("part").cast("bigint") * tasks / parts).cast("int")
    return signed.repartitionById(tasks, task).sortWithinPartitions("part").mapInArrow(run, _EDGES)


def _linked(sets: np.ndarray, first: np.ndarray, percent: int) -> np.ndarray:
    """Which sets are linked with which, as a matrix."""
    size = np.diff(first)
    n = len(size)
    universe, column = _coded(sets)
    times = np.bincount(column, minlength=len(universe))
    place = np.cumsum(times > 1) - 1
    row = np.repeat(np.arange(n), size)
    shared = times[column] > 1
    row, column = row[shared], place[column[shared]]
    common = np.zeros((n, n), np.float32)
    chunk = 1 << 14
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    columns = int(place[-1]) + 1 if len(place) else 0
    for at in range(0, columns, chunk):
        a, b = np.searchsorted(column, [at, at + chunk])
        held = np.zeros((n, min(chunk, columns - at)), np.float32)
        held[row[a:b], column[a:b] - at] = 1.0
        common += held @ held.T
    return 100 * common >= percent * (size[:, None] + size[None, :] - common)


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(values)
    universe = ordered[np.append(True, ordered[1:] != ordered[:-1])] if len(ordered) else ordered
    return universe, np.searchsorted(universe, values)


def _forest(linked: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the matrix connects: each set with the first of its component."""
    label = np.arange(len(ids))
    while True:
        new = np.where(linked, label[None, :], len(ids)).min(1)
        new = np.minimum(label, new)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(ids)))
    return ids[label[own]], ids[own]


def _compare(width: int, percent: int):
    def run(block: pa.Table) -> pa.Table:
        ids = block["doc_id"].to_numpy()
        part = block["part"].to_numpy()
        pieces = [shingle_sets(p, width) for _, _, p in text.slices(block["text"].combine_chunks(), most=MOST_TEXTS)]
        first, total = [np.zeros(1, np.int64)], 0
        for own, begin in pieces:
            first.append(begin[1:] + total)
            total += len(own)
        linked = _linked(np.concatenate([own for own, _ in pieces]), np.concatenate(first), percent)
        if part.min() != part.max():  # two blocks: each has a task of its own for what is within
            linked &= part[:, None] != part[None, :]
        a, b = _forest(linked, ids)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _near(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows of ``pairs`` (id, text, other, other_text) whose texts are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in text.slices(batch["text"], most=MOST_TEXTS):
                sets, first = shingle_sets(part, width)
                keep = []
                for i, other in enumerate(batch["other_text"].slice(a, b - a)):
                    own = sets[first[i] : first[i + 1]]
                    theirs, _ = shingle_sets(text.raw(pa.array([other.as_py()])), width)
                    common = len(np.intersect1d(own, theirs, assume_unique=True))
                    keep.append(100 * common >= percent * (len(own) + len(theirs) - common))
                rows = batch.slice(a, b - a).filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays([rows["other"], rows["id"]], ["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _possible(members: DataFrame, width: int, percent: int, hot) -> DataFrame:
    """The ids of ``members`` (component, id, text) that may have a link within their component: at
    least ``percent`` of their shingles are widespread or in another member too. Of several texts of
    one id the smallest counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in text.slices(batch["text"], most=MOST_TEXTS):
                component, ids = (batch[c].slice(a, b - a).to_numpy() for c in ("component", "id"))
                sets, first = shingle_sets(part, width)
                size = np.diff(first)
                common = hot.value[np.minimum(np.searchsorted(hot.value, sets), max(len(hot.value) - 1, 0))] == sets if len(hot.value) else np.zeros(len(sets), bool)
                owner = np.repeat(np.arange(len(size)), size)
                known = np.bincount(owner[common], minlength=len(size))
                own = owner[~common]
                key = text.mix(sets[~common] + text.mix(component[own].astype(np.uint64)))
                yield _rows(["key", "id", "size", "known"], (key.view(np.int64), ids[own], -1, np.zeros(len(own))), (text.mix(ids.astype(np.uint64)).view(np.int64), ids, size, known))

    rows = storage.written(members.select("component", "id", "text").mapInArrow(run, "key bigint, id bigint, size bigint, known bigint"), "possible")
    shingles = rows.filter("size < 0").select("key", "id")
    shared = shingles.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    found = shingles.join(shared.select("key"), "key", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
    whole = rows.filter("size >= 0").groupBy("id").agg(F.min("size").alias("size"), F.max("known").alias("known"))
    kept = whole.join(found, "id", "left")
    return kept.filter(100 * (F.col("known") + F.coalesce("shared", F.lit(0))) >= percent * F.col("size")).select("id")


def _told(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """``rows`` with the columns of their row of ``clusters``, joined by component. The rows of a large
    cluster are dealt to several tasks."""
    clusters = clusters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<int>")))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return rows.join(clusters, ["component", "salt"]).drop("salt")


def _links(
    texts: DataFrame, clusters: DataFrame, sizes: DataFrame, degree: DataFrame, width: int, percent: int, hot
) -> DataFrame:
    """Links that connect what is linked within each cluster, found by comparing its texts."""
    members = storage.written(clusters.join(sizes, "id").join(degree, "id", "left"), "members")
    whole = members.groupBy("component").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_DOCS, F.sum("n") / BLOCK_SHINGLES)).alias("blocks"),
        F.max_by("id", F.struct("degree", -F.col("id"))).alias("center"),
    )
    placed = _told(members.select("id", "component"), whole)
    in_cluster = marks.marked(members.select("id"))
    placed = placed.join(texts.filter(in_cluster(F.col("doc_id"))), F.col("id") == F.col("doc_id"))
    placed = storage.written(placed.select("id", "component", "blocks", "center", "text"), "candidates")

    # In large clusters, texts that cannot be linked go; then the members that are linked with the
    # most typical one come first.
    large = placed.filter("blocks > 1")
    possible = storage.written(_possible(large, width, percent, hot), "possible")
    count = placed.join(possible, "id", "left_semi").filter("blocks > 1")
    whole = count.groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.sum(F.length("text")).alias("chars"))
    # A shingle takes five characters of text at least, so blocks stay within their bounds.
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK_DOCS, F.col("chars") / (5 * BLOCK_SHINGLES))).alias("blocks")
    center = F.max_by("id", F.struct("degree", -F.col("id"))).alias("center")
    most = members.join(possible, "id", "left_semi").groupBy("component").agg(center)
    large = _told(count.drop("blocks", "center"), whole.select("component", blocks).join(most, "component"))
    centers = large.filter("id = center").groupBy("component").agg(F.min("text").alias("other_text"))
    pairs = _told(large.filter("id != center"), centers).select("id", "text", F.col("center").alias("other"), "other_text")
    near = storage.written(_near(pairs, width, percent), "near")
    close = near.select(F.col("b").alias("id"), F.lit(True).alias("close")).distinct()
    dealt = large.join(close, "id", "left").withColumn("close", F.coalesce("close", F.col("id") == F.col("center")))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # Blocks of close members come before the others: -blocks .. -1, and 0 .. blocks - 1.
    dealt = dealt.withColumn("part", F.expr("if(close, part - blocks, part)").cast("int"))
    other = F.explode(F.expr("sequence(if(close, 0, -blocks), blocks - 1)").cast("array<int>"))
    dealt = dealt.withColumn("against", other)
    dealt = dealt.withColumn("low", F.least("part", "against")).withColumn("high", F.greatest("part", "against"))
    small = placed.filter("blocks <= 1").withColumns({"part": F.lit(0), "low": F.lit(0), "high": F.lit(0)})
    columns = ["component", "low", "high", "part", F.col("id").alias("doc_id"), "text"]
    blocks = small.select(*columns).unionByName(dealt.select(*columns))
    found = blocks.groupBy("component", "low", "high").applyInArrow(_compare(width, percent), "a bigint, b bigint")
    return near.unionByName(found)


def join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest id reachable by links) of every row.

    Texts are lower-cased (A-Z) and split at ASCII white space. A text of fewer words than ``width``
    has its whole sequence as one shingle; a null or empty text has none and is linked with nothing.
    A null id has no component. Rows of one id are one node: their links are common, their sizes
    their own. Only doc_id and text are read.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = source.filter("doc_id is not null")
    spark = docs.sparkSession
    read = _read(known, width, percent)
    copies, different = _copies(read)
    count = different.agg(F.sum("signed")).first()[0] or 0
    # At most MAX_HOT numbers are broadcast.
    hot = spark.sparkContext.broadcast(_widespread(read))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(-(-count // RANGE_KEYS), partitions)
    bits = min(count.bit_length() + SPARE_BITS, 64)
    tasks = max(-(-count // (RANGE_KEYS * TASK_RANGES)), partitions)
    signed = _signed(known, _spared(copies, different), width, percent, hot, parts, bits)
    edges = storage.written(_edges(signed, parts, tasks), "edges")
    rows = _unpacked(read, _DOC, "id", "n")
    candidates = storage.written(edges.filter("a != b").distinct(), "candidate-edges")
    clusters = storage.written(graph.components(candidates), "clusters")
    ends = candidates.select(F.col("a").alias("id")).unionAll(candidates.select(F.col("b").alias("id")))
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    sizes = rows.groupBy("id").agg(F.max("n").alias("n"))
    links = storage.written(_links(known, clusters, sizes, degree, width, percent, hot), "links")
    found = storage.written(graph.components(links.unionByName(copies)), "components")
    named = rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"))
    named = named.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    named = named.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return named.unionByName(_nameless(source, width))


def _nameless(source: DataFrame, width: int) -> DataFrame:
    """Rows without an id: their sizes only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in text.slices(batch["text"], most=MOST_TEXTS):
                size = np.diff(shingle_sets(part, width)[1])
                empty = pa.nulls(b - a, pa.int64())
                yield pa.RecordBatch.from_arrays([empty, pa.array(size, pa.int64()), empty], ["doc_id", "n_shingles", "component_id"])

    return source.filter("doc_id is null").select("text").mapInArrow(run, "doc_id bigint, n_shingles bigint, component_id bigint")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays of each component: that of the smallest
    id, and of several rows of this id the one of the smallest text hash. Rows without id stay."""
    found = join(docs, width, percent).filter("doc_id is not null")
    found = storage.written(found.groupBy("doc_id", "component_id").agg(F.count(F.lit(1)).alias("rows_of_id")), "found")
    own = docs["doc_id"].cast("bigint")
    may_be_gone = marks.marked(found.filter("doc_id != component_id").select("doc_id"))
    # Ids that stay, but are marked by chance or have several rows. What is marked as gone and is not marked as
    # one of these goes where it is read; what is marked as neither stays: most rows are in no shuffle.
    special = found.filter("doc_id = component_id").select("doc_id", "rows_of_id")
    special = storage.written(special.filter((F.col("rows_of_id") > 1) | may_be_gone(F.col("doc_id"))), "special")
    may_be_special = marks.marked(special.select("doc_id"))
    kept = docs.filter(own.isNull() | ~(may_be_gone(own) | may_be_special(own)))
    marked = docs.filter(own.isNotNull() & may_be_special(own))
    same = own == special["doc_id"]
    loose = marked.filter(~may_be_gone(own)).join(special, same, "left_anti")
    single = marked.join(special.filter("rows_of_id = 1"), same, "left_semi")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    first = marked.join(special.filter("rows_of_id > 1"), same, "left_semi")
    first = first.groupBy(own.alias("of")).agg(F.min_by(row, F.struct(F.xxhash64("text"), "text")).alias("row"))
    return kept.unionByName(loose).unionByName(single).unionByName(first.select("row.*"))
