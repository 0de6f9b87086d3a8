import math

import numpy as np
import odd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import text, unigram

PIECES = {"▁": -3.0, "a": -2.0, "b": -2.0, "▁a": -2.5, "ab": -2.6, "▁ab": -3.0, "ba": -3.5, "▁▁": -4.0, "é": -5.0, "aba": -4.6}
BYTES = [f"<0x{b:02X}>" for b in range(256)]


def small(with_bytes=True):
    names = ["<unk>", "<s>", "</s>", *(BYTES if with_bytes else []), *PIECES]
    kinds = ["unknown", "control", "control", *["byte"] * (256 * with_bytes), *["normal"] * len(PIECES)]
    scores = [0.0] * (len(names) - len(PIECES)) + list(PIECES.values())
    return unigram.from_pieces(names, scores, kinds), names


def best(value):
    """The largest sum over all segmentations."""
    value = ("▁" + value.replace(" ", "▁")) if value else ""
    low = min(PIECES.values()) - 10
    sums = [0.0] + [-math.inf] * len(value)
    for end in range(1, len(value) + 1):
        for start in range(end):
            piece = value[start:end]
            gain = PIECES.get(piece, low if end - start == 1 and piece not in PIECES else -math.inf)
            sums[end] = max(sums[end], sums[start] + gain)
    return sums[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abc é\n漢▁"), max_size=14), min_size=1, max_size=5), st.booleans())
def test_segmentation_is_the_best_of_all(texts, one_by_one):
    v, names = small(with_bytes=False)
    long_, unigram.LONG_SEGMENT = unigram.LONG_SEGMENT, 0 if one_by_one else 512
    try:
        ids, first = unigram.encode_slice(v, text.raw(pa.array(texts)))
    finally:
        unigram.LONG_SEGMENT = long_
    low = min(PIECES.values()) - 10
    for t, a, b in zip(texts, first[:-1], first[1:]):
        total = sum(low if i == v.unknown else PIECES[names[i]] for i in ids[a:b])
        assert total == pytest.approx(best(t))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(max_size=20), max_size=5))
def test_texts_come_back(texts):
    v, _ = small()
    ids, first = unigram.encode_slice(v, text.raw(pa.array(texts, pa.string())))
    back = unigram.decode_slice(v, ids, first).to_pylist()
    assert back == [(t or "").replace("▁", " ") for t in texts]


def test_trie_holds_its_keys_only():
    draw = np.random.default_rng(1)
    keys = sorted({bytes(draw.integers(97, 101, draw.integers(1, 6)).astype(np.uint8)) for _ in range(400)})
    trie = unigram.DoubleArray.build(keys, list(range(len(keys))))
    for probe in keys[:50] + [b"zz", b"aaaaaaa", b"\xff"]:
        data = np.frombuffer(probe, np.uint8)
        found = [(int(n), int(v[0])) for s, n, v in trie.edges(data, np.array([0]), np.array([len(data)]))]
        assert found == [(n, keys.index(probe[:n])) for n in range(1, len(probe) + 1) if probe[:n] in keys]


def test_equals_the_library_on_its_vocabulary(src):
    import pyarrow.parquet as pq
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    # The library adds up single precision numbers: pieces of -1e9 would drown all others there.
    model = sentencepiece_model_pb2.ModelProto()
    with open(unigram.VOCABULARY, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    v = unigram.load()
    for i, piece in enumerate(model.pieces):
        if piece.score < -1e8:
            piece.score = v.scores[i] = -40_000
    library = SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = pq.read_table(f"{src}/documents.parquet")["text"].to_pylist()[:100] + ["", " a  b ", "😀 漢字\t", "x" * 700, "\n\n"]
    ids, first = unigram.encode_slice(v, text.raw(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [library.encode(t) for t in texts]


def test_odd_rows(spark):
    v = unigram.load()
    docs = odd.documents(spark)
    encoded = unigram.encode(docs, v)
    rows = encoded.collect()
    assert len(rows) == len(odd.TEXTS) and all(len(r["ids"]) == r["n_pieces"] for r in rows)
    assert {r["n_pieces"] for r in rows if r["doc_id"] in (2, 3)} == {0}
    texts = {r["doc_id"]: r["text"] for r in unigram.decode(encoded, v).collect() if r["doc_id"] is not None}
    assert texts == {i: t or "" for i, t in odd.TEXTS if i is not None}
    assert all(r["round_trip"] for r in unigram.round_trip(docs, v).collect())
    assert unigram.round_trip(odd.documents(spark, []), v).count() == 0


def test_broken_bytes_decode_to_the_replacement_character():
    v, names = small()
    ids = np.array([names.index("<0xE6>"), names.index("▁a")], np.int32)
    assert unigram.decode_slice(v, ids, np.array([0, 2])).to_pylist() == ["� a"]


def test_vocabulary_is_checked():
    with pytest.raises(ValueError):
        unigram.from_pieces(["<unk>", "a▁b"], [0.0, -1.0], ["unknown", "normal"])
