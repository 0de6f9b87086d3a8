import itertools

import numpy as np
import odd

from kpiloom.llm import language_id, text
from kpiloom.llm.queries import op4_language_id


def test_held_out_accuracy(spark):
    src = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{src}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in op4_language_id(spark, src).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held)


def test_viterbi_finds_the_best_path():
    draw = np.random.default_rng(3)
    for _ in range(30):
        n, kinds = int(draw.integers(1, 6)), int(draw.integers(1, 4))
        scores = draw.normal(0, 6, (n, kinds)).astype(np.float32)
        got = language_id.viterbi(scores, np.arange(n), np.array([0, n]))
        value = lambda p: sum(scores[i, s] for i, s in enumerate(p)) - language_id.SWITCH * sum(a != b for a, b in zip(p, p[1:]))
        best = max(value(p) for p in itertools.product(range(kinds), repeat=n))
        assert abs(value(got.tolist()) - best) < 1e-3


def small_model(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    return language_id.fit(df, text.remainder("doc_id", 3) > -2)


def test_scripts_narrow_and_spans_change(spark):
    rows = [(1, "en", "the cat sat on the mat with the other cats " * 5), (2, "de", "der hund und die katze sind nicht hier " * 5), (3, "ru", "кошка сидит на окне " * 5), (4, None, "the the"), (5, "xx", None)]
    model = small_model(spark, rows)
    assert model.languages == ["de", "en", "ru"]
    docs = odd.documents(spark, [(1, "the cat sat on the mat und die katze sind nicht hier der hund"), (2, "дом the"), (3, "123 — !"), (4, None), (5, "")])
    got = {r["doc_id"]: r for r in language_id.label(docs, model).collect()}
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "de"]
    assert [s["lang"] for s in got[2]["spans"]] == ["ru", "en"]
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["spans"] == [] for i in (3, 4, 5))


def test_odd_rows_ties_and_nothing_learned(spark):
    docs = odd.documents(spark)
    got = language_id.label(docs, small_model(spark, [(1, "b", "ab cd"), (2, "a", "ab cd")])).collect()
    assert len(got) == len(odd.TEXTS)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 5, 8)} == {"a"}
    empty = language_id.label(docs, small_model(spark, []))
    assert {(r["lang_pred"], r["score"]) for r in empty.collect()} == {("und", 0.0)}
    assert language_id.label(odd.documents(spark, []), small_model(spark, [])).count() == 0


def test_code_points_and_scripts():
    table = language_id.script_table()
    import pyarrow as pa

    names = [*language_id.SCRIPTS, "other"]
    words = ["abc", "é", "привет", "漢字", "😀", "123", "ábc漢"]
    letters, script = language_id.scripts_of(text.raw(pa.array(words)), table)
    assert letters.tolist() == [3, 1, 6, 2, 0, 0, 4]
    assert [names[s] if s >= 0 else None for s in script] == ["latin", "latin", "cyrillic", "han", None, None, "latin"]
