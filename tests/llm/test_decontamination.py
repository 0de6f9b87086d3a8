import hashlib

import odd
import pytest

from kpiloom.llm import decontamination


def brute(docs, items, window=10):
    windows = {}
    for item, t in items:
        w = odd.lower_words(t, odd.ALNUM)
        if item is not None:
            for k in range(max(len(w) - window + 1, min(len(w), 1))):
                windows.setdefault(tuple(w[k : k + window]), set()).add(item)
    out = []
    for i, t in docs:
        w = odd.lower_words(t, odd.ALNUM)
        hit, found = set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k : k + size])]
        names = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (10, "The QUICK brown-fox jumps over the lazy dog near the river bank today!"),
    (9, "fox jumps over the lazy dog near the river bank today and more"),
    (3, "two words"),
    (4, ""),
    (5, None),
    (None, "one"),
    (6, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16"),
    (6, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16"),
]


@pytest.mark.parametrize("block", [1 << 24, 150])
def test_hits_equal_those_of_all_windows(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rows = [*odd.TEXTS, (20, "x The quick brown. fox jumps over the lazy dog near THE river bank today and more, two words"), (21, "two words two words")]
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontamination.find(odd.documents(spark, rows), items)
    got = [tuple(r) for r in decontamination.digest(found).collect()]
    assert sorted(got, key=repr) == brute(rows, ITEMS)
    kept = decontamination.clean(odd.documents(spark, rows), items)
    assert kept.columns == odd.documents(spark, []).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in brute(rows, ITEMS) if not r[-1])


def test_longest_matches_and_their_places(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id bigint, text string")
    docs = odd.documents(spark, [(1, "x b c d e f g h i j k l y a b c d e f g h i j k z"), (2, "a b c d e f g h i")])
    got = {r["doc_id"]: r for r in decontamination.find(docs, items).collect()}
    assert [tuple(m) for m in got[1]["matches"]] == [("1", 1, 1, 11)]
    assert [tuple(s) for s in got[1]["hits"]] == [(1, 12), (13, 24)]
    assert got[2]["matches"] == [] and got[2]["hits"] == []


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id bigint, text string")
    docs = odd.documents(spark)
    assert decontamination.digest(decontamination.find(docs, items)).filter("contaminated").count() == 0
    assert decontamination.clean(docs, items).count() == len(odd.TEXTS)
    assert decontamination.find(odd.documents(spark, []), spark.createDataFrame(ITEMS, "item_id bigint, text string")).count() == 0


def test_items_without_id_are_searched(spark, tmp_path):
    import compare

    import corpus_pipeline
    from kpiloom.llm.oracle import OP5
    from kpiloom.llm.queries import op5_benchmark_decontamination

    rows = [(1, "an unnamed passage is here"), (2, "unnamed passage and named passage"), (3, "a named passage"), (4, "neither of both")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(None, "unnamed passage"), (None, "is here"), (7, "named passage")], "item_id bigint, text string")
    for name, df in (("documents", docs), ("benchmark", items)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert compare.differences(op5_benchmark_decontamination(spark, str(tmp_path)), con, OP5) == []
    kept = corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()
    assert [r["doc_id"] for r in kept] == [4]
