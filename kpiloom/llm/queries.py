"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import (
    best_position,
    bpe,
    decontamination,
    language_id,
    line_rules,
    orchard,
    ordinal,
    partenum,
    ppm,
    text,
    unigram,
    url_lm,
    warc,
    weak_toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = ppm.pretrained(docs, text.remainder("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), *(c for c in scored.columns if c not in ("doc_id", "training")))


#: Hosts with their subdomains, and the path from which a rule holds.
URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lm.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.join(table(spark, sf_dir, "documents"), width=3, percent=90)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = text.remainder("doc_id", 3)
    labelled = language_id.label(docs, language_id.fit(docs, fold != 1))
    return labelled.select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True)
    return decontamination.digest(found)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.lookup(warc.write(pages), pages)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordinal.score(docs, ordinal.fit(docs, table(spark, sf_dir, "labels"), "quality"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = text.remainder("doc_id", 5)
    model = weak_toxicity.fit(docs, table(spark, sf_dir, "labels"), fold != 0)
    scored = weak_toxicity.score(docs, model)
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.measure(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.round_trip(table(spark, sf_dir, "documents"), unigram.load())


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.top(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = orchard.integers(table(spark, sf_dir, "embeddings"), scale=1024)
    books = orchard.fit(kept, parts=4, entries=256, rounds=4)
    return orchard.digest(orchard.encode(kept, books), books)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digest(bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: query for name, query in list(globals().items()) if name.startswith("op")
}
