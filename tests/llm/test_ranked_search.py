import math
import random

import numpy as np
import odd
import pyarrow as pa
import pytest

from kpiloom.llm import best_position, text


def brute(docs, items, k=10):
    held = [(i, odd.lower_words(t, odd.ALNUM)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    wanted = {}
    for item, t in items:
        wanted.setdefault(item, set()).update(odd.lower_words(t, odd.ALNUM))
    out = []
    for item, terms in wanted.items():
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in w for _, w in held) + 1))) for t in terms}
        scored = []
        for i, w in held:
            score = 0
            for t in terms & set(w):
                m = 100 - 90 + 90 * len(w) * n_docs // n_terms
                score += weight[t] * (1_000_000_000 * w.count(t) // (1000 * w.count(t) + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [
    (10, "The QUICK brown-fox jumps over the lazy dog near the river bank today!"),
    (3, "two words"),
    (3, "one more, two"),
    (4, ""),
    (5, None),
    (None, "one row"),
    (6, "w5 w6 w7 w8 w9 w976 w1"),
    (7, "é 漢字 tail"),
    (8, "nowhere"),
]


def tables(spark, docs, items):
    return odd.documents(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("pairs, shard", [(1 << 20, 4 << 20), (4, 60)])
def test_odd_rows_equal_brute_force(spark, monkeypatch, pairs, shard):
    monkeypatch.setattr(best_position, "BLOCK_PAIRS", pairs)
    monkeypatch.setattr(best_position, "SHARD_BYTES", shard)
    found = best_position.top(*tables(spark, odd.TEXTS, ITEMS))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(odd.TEXTS, ITEMS)


@pytest.mark.parametrize("seed", range(4))
def test_many_ties_and_copies(spark, monkeypatch, seed):
    """Few different words, so that many scores are equal, over many small shards."""
    monkeypatch.setattr(best_position, "SHARD_BYTES", 400)
    monkeypatch.setattr(best_position, "FIRST_PLACES", 1 + seed)
    draw = random.Random(seed)
    docs = [(i, " ".join(draw.choices("abcdefgh", k=draw.randint(0, 6)))) for i in range(400)] + [(i, "a b c") for i in range(900, 960)]
    draw.shuffle(docs)
    items = [(i, " ".join(draw.choices("abcdefghxyz", k=draw.randint(1, 8)))) for i in range(12)]
    found = best_position.top(*tables(spark, docs, items), k=7)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(docs, items, 7)


def test_empty_tables(spark):
    assert best_position.top(*tables(spark, [], ITEMS)).count() == 0
    assert best_position.top(*tables(spark, odd.TEXTS, [])).count() == 0
    assert best_position.top(*tables(spark, [(1, None), (2, "")], ITEMS)).count() == 0


def test_reading_stops_before_the_lists_end():
    """Of 4,000 documents only the heads of the lists are read, and the best are right."""
    draw = np.random.default_rng(3)
    texts = [" ".join(["apple"] * int(a) + ["pear"] * int(a + b) + ["x"] * 30) for a, b in zip(draw.integers(1, 60, 4000), draw.integers(0, 3, 4000))]
    vocabulary = pa.array([b"apple", b"pear"], pa.binary())
    part = text.raw(pa.array(texts))
    stats = best_position.Statistics(4000, sum(t.count(" ") + 1 for t in texts), np.array([1500, 2500]))
    shard = best_position.Shard(part, pa.array(range(4000)), vocabulary, stats.weights(), stats)
    full = np.bincount(np.repeat(np.arange(4000), np.diff(shard.of_doc)), weights=shard.gain, minlength=4000).astype(np.int64)
    read = []
    found = shard.found

    class Counted(np.ndarray):
        def __setitem__(self, key, value):
            if value is True:
                read.append(len(key))
            super().__setitem__(key, value)

    shard.found = found.view(Counted)
    rows, scores = shard.search(np.array([0, 1]), 10, 0)
    order = np.lexsort((np.arange(4000), -full))[:10]
    assert rows.tolist() == order.tolist() and scores.tolist() == full[order].tolist()
    assert sum(read) < 2000
    assert not shard.found.any() and not shard.seen.any() and not shard.asked.any()
    assert shard.search(np.array([0, 1]), 10, int(full.max()) * 2)[0].tolist() == []


def test_lengths_do_not_overflow():
    stats = best_position.Statistics(30_000_000_000, 9_000_000_000_000, np.array([1]))
    n = np.array([1, 5_000_000_000])
    assert stats.lengths(n).tolist() == [10 + 90 * int(x) * 30_000_000_000 // 9_000_000_000_000 for x in n]
