"""SentencePiece encoding and decoding: unigram segmentation by Viterbi over a double-array trie.

A vocabulary file gives pieces with log scores. A text gets a leading space, spaces become the
marker, and the sequence of pieces with the largest sum of scores is its encoding; of equal sums
the one whose last piece is longest, as its library does. Characters that no piece covers cost the
lowest score less ten and become one piece for each of their bytes.

No piece holds a marker after another character (checked on loading), so the best path of a text is
the best paths of its segments, which begin where a space follows something else. Each slice of
texts is therefore reduced to its different segments, and these are walked through the trie and
relaxed all at once, position by position. Segments beyond ``LONG_SEGMENT`` bytes go one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import text

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
LONG_SEGMENT = 512

#: Text reduced to its different segments at once, and segments walked through the trie at once.
SLICE_BYTES, CHUNK_BYTES = 4 << 20, 1 << 18

#: Vocabularies are sent to every task; a larger one is refused.
MAX_PIECES = 1 << 20
_UNKNOWN_PENALTY = 10.0


class DoubleArray:
    """A trie of byte strings in two arrays: the child of node s for byte c is at base[s] + c, and
    is one iff check there is s."""

    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base, check, value

    @classmethod
    def build(cls, keys: list[bytes], values: list[int]) -> DoubleArray:
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for key, value in zip(keys, values, strict=True):
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            ends[node] = value
        # Wide nodes first find their room by testing many places at once; a rising lower bound
        # keeps them off ground that is nearly full. Nodes of one child fill the gaps.
        size = 4 * len(children) + 4096
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0] = False
        slot, queue, lowest, single = {0: 0}, [0], 1, 256
        for node in queue:
            own = sorted(children[node])
            queue.extend(children[node][b] for b in own)
            if node in ends:
                value[slot[node]] = ends[node]
            if not own:
                continue
            if len(own) == 1:
                single += int(free[single:].argmax())
                at = single - own[0]
            else:
                at = lowest
                while True:
                    fits = np.logical_and.reduce([free[at + b : at + b + 1024] for b in own])
                    if fits.any():
                        at += int(fits.argmax())
                        break
                    at += 1024
                while free[lowest : lowest + 1024].sum() < 64:
                    lowest += 1024
            if at + 1300 >= size:
                base, check, value = (
                    np.append(x, np.full(size, fill, np.int32)) for x, fill in ((base, 0), (check, -1), (value, -1))
                )
                free = np.append(free, np.ones(size, bool))
                size *= 2
            base[slot[node]] = at
            for b in own:
                free[at + b] = False
                check[at + b] = slot[node]
                slot[children[node][b]] = at + b
        used = int(np.flatnonzero(check >= 0).max(initial=0)) + 257
        return cls(base[:used], check[:used], value[:used])

    def edges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Pieces from each start on, within its end: (starts, length, values), for rising length."""
        state = np.zeros(len(starts), np.int32)
        length = 0
        while len(starts):
            at = self.base[state] + data[starts + length]
            held = self.check[at] == state
            starts, ends, state = starts[held], ends[held], at[held]
            length += 1
            value = self.value[state]
            found = value >= 0
            if found.any():
                yield starts[found], length, value[found]
            more = starts + length < ends
            starts, ends, state = starts[more], ends[more], state[more]


@dataclass
class Vocabulary:
    trie: DoubleArray
    scores: np.ndarray
    pieces: list[bytes]
    plain: np.ndarray  # what each piece decodes to, without markers: kind 0 text, 1 byte, 2 nothing, 3 unknown
    byte_ids: np.ndarray
    unknown: int
    breaks: bool  # no piece holds a line break

    def state(self) -> dict:
        """Plain data, for sending to tasks."""
        return vars(self) | {"trie": vars(self.trie)}

    @classmethod
    def restored(cls, state: dict) -> Vocabulary:
        return cls(**state | {"trie": DoubleArray(**state["trie"])})


def from_pieces(pieces: list[str], scores: list[float], kinds: list[str]) -> Vocabulary:
    """``kinds``: normal, byte, control, unused or unknown for each piece."""
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"{len(pieces)} pieces; at most {MAX_PIECES}")
    normal = [i for i, kind in enumerate(kinds) if kind == "normal"]
    odd = [pieces[i] for i in normal if MARKER in pieces[i].lstrip(MARKER)]
    if odd:
        raise ValueError(f"a marker follows another character in pieces such as {odd[0]!r}")
    byte_ids = np.full(256, -1, np.int32)
    for i, kind in enumerate(kinds):
        if kind == "byte":
            byte_ids[int(pieces[i][3:5], 16)] = i
    out = []
    for piece, kind in zip(pieces, kinds, strict=True):
        if kind == "byte":
            out.append(bytes([int(piece[3:5], 16)]))
        elif kind == "control":
            out.append(b"")
        elif kind == "unknown":
            out.append(" ⁇ ".encode())
        else:
            out.append(piece.replace(MARKER, " ").encode())
    return Vocabulary(
        trie=DoubleArray.build([pieces[i].encode() for i in normal], normal),
        scores=np.array(scores, np.float64),
        pieces=out,
        plain=np.array([{"byte": 1, "control": 2, "unknown": 3}.get(kind, 0) for kind in kinds], np.int8),
        byte_ids=byte_ids,
        unknown=kinds.index("unknown"),
        breaks=not any("\n" in pieces[i] for i in normal),
    )


def load(path: str = VOCABULARY) -> Vocabulary:
    """The vocabulary of a SentencePiece model file; its scores are taken as log scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())

    def kind(i: int) -> str:
        for name in ("byte", "control", "unused", "unknown"):
            if getattr(model, f"is_{name}")(i):
                return name
        return "normal"

    return from_pieces([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], [kind(i) for i in ids])


def _segments(texts: text.Raw, breaks: bool) -> tuple[text.Raw, np.ndarray]:
    """Texts with a leading space as segments, and the first segment of each text."""
    length = np.diff(texts.offsets)
    padded = texts.offsets + np.concatenate([[0], np.cumsum(length > 0)])
    own = np.ones(padded[-1], bool)
    own[padded[:-1][length > 0]] = False
    data = np.full(padded[-1], 0x20, np.uint8)
    data[own] = texts.data
    space = data == 0x20
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    if len(data) > 3:  # a literal marker may share a piece with the space behind it
        marker = (data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81)
        cut[3:] &= ~marker
    if breaks:
        line = data == 0x0A
        cut |= line
        cut[1:] |= line[:-1]
    cut[padded[:-1][length > 0]] = True
    starts = np.flatnonzero(cut)
    return text.Raw(data, np.append(starts, len(data))), np.searchsorted(starts, padded)


def _best(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best path of each segment, one after the other, and each segment's first id."""
    n = len(offsets) - 1
    length = np.diff(offsets)
    head = (data & 0xC0) != 0x80
    owner = np.repeat(np.arange(n), length)
    at = np.flatnonzero(head)
    ends = offsets[1:][owner[at]]
    starts, sizes, ids = [], [], []
    single = np.zeros(len(data), bool)
    char = np.diff(np.append(at, len(data)))
    char_at = np.zeros(len(data), np.int64)
    char_at[at] = char
    for s, size, value in vocabulary.trie.edges(data, at, ends):
        starts.append(s)
        sizes.append(np.full(len(s), size, np.int64))
        ids.append(value)
        single[s[char_at[s] == size]] = True
    bare = at[~single[at]]
    starts, sizes, ids = (
        np.concatenate([*x, y])
        for x, y in ((starts, bare), (sizes, char_at[bare]), (ids, np.full(len(bare), vocabulary.unknown, np.int32)))
    )
    unknown_score = vocabulary.scores[vocabulary.plain == 0].min(initial=0.0) - _UNKNOWN_PENALTY
    score = np.where(ids == vocabulary.unknown, unknown_score, vocabulary.scores[ids])

    best = np.full(len(data) + n, -np.inf)  # a place for each position of a segment, its end included
    place = offsets[:-1] + np.arange(n)
    best[place] = 0.0
    came, with_id = np.zeros(len(best), np.int64), np.zeros(len(best), np.int32)
    step = starts - offsets[:-1][owner[starts]]
    source = starts + owner[starts]
    target = source + sizes
    long_ = length[owner[starts]] > LONG_SEGMENT
    for chosen in _rounds(step, sizes, ~long_):
        a, b = source[chosen], target[chosen]
        new = best[a] + score[chosen]
        better = new > best[b]
        b = b[better]
        best[b], came[b], with_id[b] = new[better], a[better], ids[chosen][better]
    order = np.flatnonzero(long_)
    order = order[np.lexsort((target[order], source[order]))]
    for a, b, gain, i in zip(source[order].tolist(), target[order].tolist(), score[order].tolist(), ids[order].tolist(), strict=True):
        if best[a] + gain > best[b]:
            best[b], came[b], with_id[b] = best[a] + gain, a, i

    on_path = np.zeros(len(best), bool)
    now, stop = offsets[1:] + np.arange(n), place
    while len(now):
        going = now > stop
        now, stop = now[going], stop[going]
        on_path[now] = True
        now = came[now]
    tips = np.flatnonzero(on_path)
    first = np.searchsorted(tips, place, "right")
    return _with_bytes(vocabulary, data, offsets, tips, with_id[tips], came[tips], np.append(first, len(tips)))


def _best_of_all(vocabulary: Vocabulary, segments: text.Raw) -> tuple[np.ndarray, np.ndarray]:
    """``_best``, a bounded number of bytes at a time."""
    ids, first, total, at = [], [np.zeros(1, np.int64)], 0, 0
    while at < len(segments):
        end = int(np.searchsorted(segments.offsets, segments.offsets[at] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, at + 1), len(segments))
        offsets = segments.offsets[at : end + 1]
        own, begin = _best(vocabulary, segments.data[offsets[0] : offsets[-1]], offsets - offsets[0])
        ids.append(own)
        first.append(begin[1:] + total)
        total += len(own)
        at = end
    return np.concatenate([*ids, np.zeros(0, np.int32)]), np.concatenate(first)


def _rounds(step: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> Iterator[np.ndarray]:
    """Edges in the order of their start within the segment, then length; one of each per segment."""
    edges = np.flatnonzero(chosen)
    if not len(edges):
        return
    widest = int(sizes[edges].max()) + 1
    key = (step[edges] * widest + sizes[edges]).astype(np.uint32)
    key = key.astype(np.uint16) if key.max() < 1 << 16 else key
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    yield from np.split(edges[order], cuts)


def _with_bytes(vocabulary, data, offsets, tips, ids, came, first):
    """Unknown characters as a piece for each byte, where the vocabulary has such pieces."""
    unknown = ids == vocabulary.unknown
    if not unknown.any() or (vocabulary.byte_ids < 0).any():
        return ids, first
    times = np.where(unknown, tips - came, 1)
    begin = np.concatenate([[0], np.cumsum(times)])
    out = np.repeat(ids, times)
    segment = np.searchsorted(first, np.arange(len(ids)), "right") - 1
    inner = np.arange(len(out)) - np.repeat(begin[:-1], times)
    source = np.repeat(came - segment, times) + inner
    held = np.repeat(unknown, times)
    out[held] = vocabulary.byte_ids[data[source[held]]]
    return out, begin[first]


def encode_slice(vocabulary: Vocabulary, texts: text.Raw) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and each text's first."""
    parts, first = _segments(texts, vocabulary.breaks)
    if not len(parts.data):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    coded = pa.BinaryArray.from_buffers(
        pa.binary(), len(parts), [None, pa.py_buffer(parts.offsets.astype(np.int32)), pa.py_buffer(parts.data)]
    ).dictionary_encode()
    different = text.raw(pc.replace_substring(coded.dictionary, b" ", MARKER.encode()))
    ids, begin = _best_of_all(vocabulary, different)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    size = np.diff(begin)[codes]
    end = np.concatenate([[0], np.cumsum(size)])
    flat = ids[np.arange(end[-1]) - np.repeat(end[:-1], size) + np.repeat(begin[codes], size)]
    return flat, end[first]


def decode_slice(vocabulary: Vocabulary, ids: np.ndarray, first: np.ndarray) -> pa.Array:
    """Texts of ids: markers as spaces, byte pieces as the bytes they stand for (a broken sequence
    as the replacement character), without the leading space."""
    pieces = pa.array(vocabulary.pieces, pa.large_binary())
    joined = text.raw(pieces.take(pa.array(ids, pa.int32())))
    begin, end = joined.offsets[first[:-1]], joined.offsets[first[1:]]
    skip = np.zeros(len(begin), np.int64)
    filled = np.flatnonzero(end > begin)
    skip[filled] = joined.data[begin[filled]] == 0x20
    out = pa.array([joined.data[a:b].tobytes() for a, b in zip(begin + skip, end, strict=True)], pa.binary())
    try:
        return out.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.as_py().decode("utf-8", "replace") for x in out], pa.string())


ENCODED = "ids array<int>, n_pieces bigint, n_bytes bigint"


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id``, ``ids``, their number and how many are byte pieces; a row for each row.

    A null or empty text has no ids. Repeated rows are encoded each. Only doc_id and text are read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary.state())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary.restored(shipped.value)
        is_byte = own.plain == 1
        for batch in batches:
            for a, b, part in text.slices(batch["text"], SLICE_BYTES):
                ids, first = encode_slice(own, part)
                byte = np.concatenate([[0], np.cumsum(is_byte[ids])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(byte[first[1:]] - byte[first[:-1]], pa.int64()),
                    ],
                    ["doc_id", "ids", "n_pieces", "n_bytes"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, {ENCODED}")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The rows of ``encoded`` with the ``text`` of their ``ids``; null ids give an empty text."""
    shipped = encoded.sparkSession.sparkContext.broadcast(vocabulary.state())
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "text")
    names = [name for name in encoded.columns if name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary.restored(shipped.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                flat = part["ids"].flatten().to_numpy(zero_copy_only=False)
                size = pc.list_value_length(part["ids"]).fill_null(0).to_numpy(zero_copy_only=False)
                texts = decode_slice(own, flat, np.concatenate([[0], np.cumsum(size)]))
                yield pa.RecordBatch.from_arrays([*(part[n] for n in names), texts], [*names, "text"])

    return encoded.select(*names).mapInArrow(run, f"{kinds}, text string")


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encode``, and whether decoding gives the text back (a literal marker comes back as a
    space; null counts as empty)."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary.state())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary.restored(shipped.value)
        is_byte = own.plain == 1
        for batch in batches:
            for a, b, part in text.slices(batch["text"], SLICE_BYTES):
                ids, first = encode_slice(own, part)
                wanted = pc.replace_substring(batch["text"].slice(a, b - a).fill_null(""), MARKER, " ")
                same = pc.equal(decode_slice(own, ids, first), wanted)
                byte = np.concatenate([[0], np.cumsum(is_byte[ids])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(byte[first[1:]] - byte[first[:-1]], pa.int64()),
                        same,
                    ],
                    ["doc_id", "ids", "n_pieces", "n_bytes", "round_trip"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, {ENCODED}, round_trip boolean"
    )
