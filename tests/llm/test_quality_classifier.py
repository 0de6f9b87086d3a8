import numpy as np
import odd
import pyarrow as pa
import pytest

from kpiloom.llm import ordinal
from kpiloom.llm.queries import op7_quality_classifier


def graded(n, seed=1):
    """Texts of three grades: the share of good words rises with the grade."""
    draw = np.random.default_rng(seed)
    out = []
    for i in range(n):
        grade = int(draw.integers(0, 3))
        words = [f"good{draw.integers(20)}" if draw.random() < 0.1 + 0.4 * grade else f"bad{draw.integers(20)}" for _ in range(40)]
        out.append((i, " ".join(words), float(grade)))
    return out


def test_grades_are_ordered(spark):
    rows = graded(600)
    docs = odd.documents(spark, [(i, t) for i, t, _ in rows])
    ratings = spark.createDataFrame([(i, g) for i, _, g in rows if i < 400] + [(None, 1.0), (5, None)], "doc_id bigint, stars double")
    model = ordinal.fit(docs, ratings, "stars")
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    got = {r["doc_id"]: r for r in ordinal.score(docs, model, cut=2.0).collect()}
    held = [(g, got[i]) for i, _, g in rows if i >= 400]
    assert np.mean([abs(r["expected_grade"] - g) for g, r in held]) < 0.35
    assert np.mean([r["accepted"] == (g >= 2) for g, r in held]) > 0.85


def test_held_out_documents_of_the_tables(spark):
    src = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{src}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{src}/documents.parquet")
    even = spark.read.parquet(f"{src}/labels.parquet").filter("doc_id % 2 = 0")
    got = [r for r in ordinal.score(docs, ordinal.fit(docs, even, "quality")).collect() if r["doc_id"] in labels and r["doc_id"] % 2]
    good = [r["accepted"] for r in got if labels[r["doc_id"]]]
    bad = [r["accepted"] for r in got if not labels[r["doc_id"]]]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.3
    assert op7_quality_classifier(spark, src).count() == 1000


def test_gradient_is_that_of_the_loss():
    lists = pa.array([[1, 5], [5], [1], [2, 5], [1, 2], [2]] * 4, pa.list_(pa.int32()))
    values = pa.array([[0.5, 1.0], [1.0], [0.3], [0.2, 0.1], [1.0, 1.0], [0.7]] * 4, pa.list_(pa.float32()))
    table = pa.table({"grade": [0.0, 1.0, 2.0, 0.0, 1.0, 2.0] * 4, "bucket": lists, "value": values})
    seen = []
    ordinal_minimise = ordinal.minimise

    def spy(loss, x, rounds):
        point = x + np.linspace(-0.2, 0.3, len(x))
        value, gradient = loss(point)
        for k in range(len(x)):
            step = np.zeros(len(x))
            step[k] = 1e-6
            seen.append((loss(point + step)[0] - value) / 1e-6 - gradient[k])
        return ordinal_minimise(loss, x, rounds)

    ordinal.minimise = spy
    try:
        ordinal.fit_sample(table)
    finally:
        ordinal.minimise = ordinal_minimise
    assert len(seen) >= 5 and max(map(abs, seen)) < 1e-4


@pytest.mark.parametrize("ratings, accepted", [([], True), ([(1, 1.0)], True), ([(1, 0.0)], False)])
def test_few_ratings(spark, ratings, accepted):
    docs = odd.documents(spark)
    model = ordinal.fit(docs, spark.createDataFrame(ratings, "doc_id bigint, stars double"), "stars")
    assert {r["accepted"] for r in ordinal.score(docs, model).collect()} == {accepted}
    kept = ordinal.select(docs, model)
    assert kept.columns == docs.columns and kept.count() == (len(odd.TEXTS) if accepted else 0)


def test_odd_rows_and_empty_table(spark):
    rows = graded(60)
    docs = odd.documents(spark, [(100 + i, t) for i, t, _ in rows])
    ratings = spark.createDataFrame([(100 + i, g) for i, _, g in rows], "doc_id bigint, stars double")
    model = ordinal.fit(docs, ratings, "stars")
    got = ordinal.score(odd.documents(spark), model).collect()
    assert len(got) == len(odd.TEXTS) and all(0 <= r["tail_probability"] <= 1 for r in got)
    assert len({r["tail_probability"] for r in got if r["doc_id"] in (2, 3, 4)}) == 1
    assert ordinal.score(odd.documents(spark, []), model).count() == 0
