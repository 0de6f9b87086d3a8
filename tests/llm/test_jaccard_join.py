"""Components against all pairs, and blocks of a large cluster."""

import random

import odd
import pytest

from kpiloom.llm import graph, partenum


def brute(rows, width, percent):
    sets = []
    for _, t in rows:
        w = odd.lower_words(t)
        sets.append({tuple(w[k : k + width]) for k in range(max(len(w) - width + 1, min(len(w), 1)))})
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            j = rows[b][0]
            if i is None or j is None or not sets[a] or not sets[b]:
                continue
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), root(i) if i is not None else None) for (i, _), s in zip(rows, sets)), key=repr)


def group(n, words, edits, seed, start):
    """Copies of one text with some words changed."""
    draw = random.Random(seed)
    base = [f"b{draw.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(draw.randrange(edits + 1)):
            own[draw.randrange(words)] = f"e{draw.randrange(10**6)}"
        out.append((start + i, " ".join(own)))
    return out


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (1, 50)])
def test_components_equal_those_of_all_pairs(spark, monkeypatch, width, percent):
    monkeypatch.setattr(partenum, "BLOCK_DOCS", 8)
    rows = [r for r in odd.TEXTS] + group(60, 60, 6, 1, 100) + group(25, 9, 2, 2, 300) + group(10, 4, 1, 3, 400)
    got = [tuple(r) for r in partenum.join(odd.documents(spark, rows), width, percent).collect()]
    assert sorted(got, key=repr) == brute(rows, width, percent)


def test_documents_of_the_small_table(spark, src):
    docs = spark.read.parquet(f"{src}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [tuple(r) for r in partenum.join(docs, 5, 80).collect()]
    assert sorted(got, key=repr) == brute(rows, 5, 80)


def test_one_row_of_each_component_is_kept(spark):
    docs = odd.documents(spark)
    kept = partenum.keep_one(docs)
    assert kept.columns == docs.columns
    # 7 repeats 1; both rows without an id stay, and empty texts are linked with nothing.
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 6, 8, 9, 10]


def test_repeated_rows_leave_one(spark):
    kept = partenum.keep_one(odd.documents(spark, [(7, "a b c d e f"), (7, "a b c d e f"), (7, "other words of the same id")]))
    assert kept.count() == 1


def test_empty_table(spark):
    assert partenum.join(odd.documents(spark, [])).count() == 0
    assert partenum.keep_one(odd.documents(spark, [])).count() == 0


def test_linked_sets_share_a_signature():
    import numpy as np

    draw = np.random.default_rng(5)
    for _ in range(300):
        n = int(draw.integers(1, 300))
        a = np.unique(draw.integers(0, 1 << 50, n).astype(np.uint64))
        changed = int(draw.integers(0, max(1, n // 6) + 1))
        b = np.unique(np.concatenate([a[changed:], draw.integers(0, 1 << 50, int(draw.integers(0, 4))).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        for percent in (80, 90):
            if len(b) and 100 * common >= percent * (len(a) + len(b) - common):
                both, first = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
                for hot in (None, a[: len(a) // 2], np.union1d(a, b)):
                    keys, owner = partenum.signatures(both, first, percent, hot)
                    assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    edges = spark.createDataFrame([*path, (100, 101), (100, 102), (7, 7), (None, 3)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in graph.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert graph.components(edges.limit(0)).count() == 0


def test_many_short_texts_in_one_batch(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "40000")
    try:
        docs = spark.range(20_000).selectExpr("id as doc_id", "concat('text ', id, ' stands alone') as text").coalesce(1)
        got = partenum.join(docs, width=3, percent=90).collect()
    finally:
        spark.conf.set(name, before)
    assert len(got) == 20_000 and {r["n_shingles"] for r in got} == {2}
    assert all(r["component_id"] == r["doc_id"] for r in got)


def test_copies_of_other_slices_do_not_sign(spark, monkeypatch):
    """Thirty copies of six texts in ten slices: no edge of a shared signature, and each copy found."""
    seen, write = {}, partenum.storage.written

    def counted(df, label):
        table = write(df, label)
        seen[label] = table.count()
        return table

    monkeypatch.setattr(partenum.storage, "written", counted)
    draw = random.Random(9)
    texts = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(60)) for _ in range(6)]
    docs = odd.documents(spark, [(i, texts[i % 6]) for i in range(180)]).repartition(10)
    assert {r["doc_id"]: r["component_id"] for r in partenum.join(docs).collect()} == {i: i % 6 for i in range(180)}
    assert seen["edges"] == 0
    assert sorted(r["doc_id"] for r in partenum.keep_one(docs).collect()) == list(range(6))


def test_ids_marked_by_chance(spark, monkeypatch):
    """Bitmaps so small that they mark most ids: nothing is lost, nothing stays twice."""
    monkeypatch.setattr(partenum.marks, "MAX_BITS", 64)
    rows = group(40, 60, 4, 4, 0) + group(6, 30, 0, 5, 100) + [(200 + i, f"words of number {i} that stand all alone {i}") for i in range(60)]
    rows += [(210, "another row of one id"), (210, "another row of one id"), (3, rows[41][1]), (None, rows[0][1]), (300, "")]
    whole = brute(rows, 5, 80)
    docs = odd.documents(spark, rows)
    assert sorted((tuple(r) for r in partenum.join(docs).collect()), key=repr) == whole
    kept = sorted((r["doc_id"] for r in partenum.keep_one(docs).collect()), key=repr)
    assert kept == sorted({i for i, _, c in whole if i is not None and i == c} | {None}, key=repr)
