import hashlib

import numpy as np
import odd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiloom.llm import orchard


def brute(rows, parts=4, entries=256, rounds=4):
    """Plain loops over all entries."""
    kept = [(i, [int(np.floor(1024.0 * x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[k * width : (k + 1) * width] for k in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    books = [[cut[r][k] for r in order] for k in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            groups = {}
            for row in cut:
                groups.setdefault(near(row[k], books[k])[1], []).append(row[k])
            books[k] = [[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else old for e, old in enumerate(books[k])]
    final = [[near(row[k], books[k]) for k in range(parts)] for row in cut]
    error = [sum(d for d, _ in row) for row in final]
    by_label = {}
    for (_, _, label), e in zip(kept, error):
        by_label[label] = by_label.get(label, 0) + e
    numbers = ",".join(str(x) for book in books for c in book for x in c)
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for _, e in row), error[r], by_label[label], digest) for r, ((i, _, label), row) in enumerate(zip(kept, final))), key=repr)


def coded(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({name: F.lit("x") for name in odd.EXTRA})
    kept = orchard.integers(df)
    books = orchard.fit(kept, **kw)
    return orchard.digest(orchard.encode(kept, books), books)


def draw(seed, n, width, levels=5):
    rng = np.random.default_rng(seed)
    vectors = (rng.integers(-levels, levels + 1, (n, width)) / 1024 + 0.0003).astype(np.float32)
    return [(int(i), [float(x) for x in v], int(i) % 3 if i % 7 else None) for i, v in zip(rng.permutation(n), vectors)]


@pytest.mark.parametrize("entries, width", [(256, 8), (5, 4), (16, 12)])
def test_codes_equal_brute_force(spark, entries, width):
    rows = draw(entries, 300, width)
    rows += rows[:20] + [(3, rows[0][1], 1), (None, rows[1][1], 2), (None, rows[2][1], None)]  # repeated rows and ids
    bad = [(900, None, 1), (901, [None] * width, 1), (902, [float("nan")] * width, 2), (-5, [float("inf")] + [0.0] * (width - 1), 2)]
    assert odd.rows_of(coded(spark, rows + bad, entries=entries)) == brute(rows, entries=entries)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=2, max_size=2), min_size=1, max_size=30), st.lists(st.lists(st.integers(-4, 4), min_size=2, max_size=2), min_size=1, max_size=20))
def test_walks_find_the_first_of_the_nearest(entries, vectors):
    entries, vectors = np.array(entries, np.int64), np.array(vectors, np.int64)
    entry, distance = orchard.Codebook(entries).nearest(vectors)
    gaps = ((vectors[:, None] - entries[None]) ** 2).sum(axis=2)
    assert entry.tolist() == gaps.argmin(axis=1).tolist() and distance.tolist() == gaps.min(axis=1).tolist()


def test_walks_look_at_few_entries():
    rng = np.random.default_rng(0)
    entries = rng.integers(-100_000, 100_000, (256, 2))
    looked = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                looked.append(len(key))
            return np.asarray(super().__getitem__(key))

    book = orchard.Codebook(entries)
    book.entries = entries.view(Counted)
    book.nearest(entries[rng.integers(0, 256, 1000)] + rng.integers(-3000, 3000, (1000, 2)))
    assert sum(looked) < 1000 * 60


def test_decoding_gives_the_chosen_entries(spark):
    rows = draw(2, 60, 8)
    kept = orchard.integers(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"))
    books = orchard.fit(kept, entries=16, rounds=2)
    codes = {r["vec_id"]: r for r in orchard.encode(kept, books).collect()}
    for r in kept.collect():
        back = orchard.decode(np.frombuffer(codes[r["vec_id"]]["code"], np.uint8)[None], books)[0]
        assert ((np.array(r["vector"]) - back) ** 2).sum() == codes[r["vec_id"]]["error"]


def test_empty_and_uneven_tables(spark):
    assert coded(spark, []).count() == 0
    assert coded(spark, [(1, None, 1)]).count() == 0
    assert sorted(tuple(r)[:4] for r in coded(spark, [(1, [], 1), (2, [], 1)]).collect()) == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]
    rows = draw(1, 40, 8)
    assert odd.rows_of(coded(spark, rows + [(1, [0.5] * 4, 1), (2, [], 1)])) == brute(rows)
    with pytest.raises(ValueError):
        coded(spark, [(1, [0.5] * 6, 1)])
    with pytest.raises(Exception, match="beyond 64 bits"):
        coded(spark, [(1, [3e38] * 8, 1)]).collect()
