"""Scores against a trie counted byte by byte."""

import pyarrow as pa
import numpy as np
import math
import zlib
from collections import Counter

import odd
import pytest

from kpiloom.llm import ppm, text


def expected(rows, order):
    trains = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 != 2 or i is None
    streams = [("\n" * order + " ".join(odd.lower_words(t)) + "\n").encode() for _, t in rows]
    trie, counts, ends = ppm.Trie(order), Counter(), 0
    for (i, t), data in zip(rows, streams):
        if trains(i):
            for at in range(order, len(data)):
                trie.learn(data[at - order : at], data[at])
            counts.update(odd.lower_words(t))
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for (i, t), data in zip(rows, streams):
        words = odd.lower_words(t)
        score = sum(math.log10(trie.probability(data[at - order : at], data[at])) for at in range(order, len(data)))
        base = sum(math.log10((c + 1) / (total + kinds + 1)) for c in [*(counts[w] for w in words), ends])
        known = sum(counts[w] > 0 for w in words) + (ends > 0)
        out.append((i, trains(i), len(words) + 1, known, total, base, score))
    return out


@pytest.mark.parametrize("order", [2, 5])
def test_scores_equal_those_of_a_trie(spark, monkeypatch, order):
    monkeypatch.setattr(ppm, "SLICE_BYTES", 200)
    rows = [(i, t) for i, t in odd.TEXTS if t != odd.LONG] + [(20 + i, f"The {i} quick  BROWN é fox") for i in range(12)]
    got = ppm.pretrained(odd.documents(spark, rows), text.remainder("doc_id", 7) != 2, order)
    got, want = odd.rows_of(got), sorted(expected(rows, order), key=repr)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[2], round(r[6], 6))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(a)[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6])


def test_probabilities_sum_to_one():
    trie = ppm.Trie(3)
    data = b"\n\n\nabracadabra\n"
    for at in range(3, len(data)):
        trie.learn(data[at - 3 : at], data[at])
    for before in (b"abr", b"zzz", b"aca", b"\n\n\n"):
        assert sum(trie.probability(before, s) for s in range(256)) == pytest.approx(1.0)


def test_without_training_rows_all_bytes_are_alike(spark):
    rows = ppm.pretrained(odd.documents(spark, [(1, "ab c"), (2, None)]), text.remainder("doc_id", 7) > 99).collect()
    assert {r["doc_id"]: round(r["score"] / math.log10(1 / 256), 6) for r in rows} == {1: 5, 2: 1}
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in rows)


def test_empty_table_and_long_text(spark):
    assert ppm.pretrained(odd.documents(spark, []), text.remainder("doc_id", 7) != 2).count() == 0
    row = ppm.pretrained(odd.documents(spark, [(1, odd.LONG)]), text.remainder("doc_id", 7) < 99).first()
    assert row["n_tokens"] == 120_001 and row["score"] > row["base_score"]


def test_adaptive_learns_within_the_text(spark):
    docs = odd.documents(spark, [(1, "abc " * 50), (2, None), (3, "")])
    got = {r["doc_id"]: r["score"] for r in ppm.adaptive(docs).collect()}
    assert got[2] == got[3] == pytest.approx(math.log10(1 / 256))
    assert -got[1] < 0.25 * 200 * math.log10(256)


def test_slots_find_every_key():
    draw = np.random.default_rng(8)
    for size in (1, 2, 1000, 50_000):
        keys = np.unique(draw.integers(0, 1 << 48, size))
        wanted = draw.choice(keys, 3 * size)
        assert (ppm._Slots(keys).find(wanted) == np.searchsorted(keys, wanted)).all()
    assert len(ppm._Slots(np.zeros(0, np.int64)).find(np.zeros(0, np.int64))) == 0


def test_uncounted_requests_are_the_same_keys():
    rows = pa.RecordBatch.from_pydict({"text": ["ab ab c", None, "c d ab", ""], "training": [True, True, False, False]})
    counted, alone = ppm._requests(rows, 3), ppm._requests(rows, 3, counted=False)
    assert (counted[0] == alone[0]).all() and counted[2].equals(alone[2])
    assert dict(zip(counted[2].to_pylist(), counted[3].tolist())) == {b"ab": 2, b"c": 1, b"d": 0}
