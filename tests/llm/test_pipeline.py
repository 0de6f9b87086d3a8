"""Stages of the pipeline: each against the rows it must keep."""

import odd
import pytest

import corpus_pipeline
from kpiloom.llm import line_rules, partenum


@pytest.fixture(scope="module")
def stages(spark, src):
    """What each stage makes of the one before it."""
    docs, out = spark.read.parquet(f"{src}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        from kpiloom.llm import storage

        docs = storage.written(stage(spark, docs, src), name)
        out[name] = docs
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_order_and_columns(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece"]
    assert all(stages[n].schema == stages["documents"].schema for n in names[:-1])


def test_rules_remove_lines_and_documents(stages):
    kept = {r["doc_id"] for r in line_rules.measure(stages["documents"]).collect() if r["kept"]}
    assert ids(stages["quality_rules"]) == kept
    assert all(r["n_chars"] == len(r["text"]) for r in stages["quality_rules"].collect())


def test_good_documents_are_kept_by_the_classifier(spark, src, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{src}/labels.parquet").collect()}
    before, after = ids(stages["quality_rules"]), ids(stages["quality_classifier"])
    good = [i for i in before if labels.get(i) == 1]
    assert after <= before and sum(i in after for i in good) >= 0.98 * len(good)


def test_one_of_each_group_stays(stages):
    before = stages["quality_classifier"]
    groups = {r["doc_id"]: r["component_id"] for r in partenum.join(before).collect()}
    assert ids(stages["ngram_jaccard_join"]) == set(groups.values())


def test_contaminated_documents_go(spark, src, stages):
    from test_decontamination import brute

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{src}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], r["text"]) for r in stages["ngram_jaccard_join"].collect()]
    assert ids(stages["benchmark_decontamination"]) == {r[0] for r in brute(docs, items) if not r[-1]}


def test_texts_survive_encoding(stages):
    rows = stages["sentencepiece"].collect()
    assert len(rows) == stages["benchmark_decontamination"].count() and all(r["round_trip"] for r in rows)


def test_run_gives_the_last_stage(spark, src, stages):
    got = corpus_pipeline.run(spark, src)
    assert odd.rows_of(got) == odd.rows_of(stages["sentencepiece"])


def test_stages_bear_odd_rows(spark, src):
    docs = odd.documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, src)
            assert name == "sentencepiece" or out.columns == docs.columns
            assert out.count() <= docs.count()
