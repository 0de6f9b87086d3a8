"""Rows that operators must bear: nulls, empty and long texts, repeats, extra columns."""

import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

#: Names that operators use inside stand here as extra columns of the input.
EXTRA = (
    "hits", "matches", "n_words", "score", "component", "component_id", "id", "key", "kind", "part", "slice",
    "grade", "q", "pattern", "training", "ids", "word", "gram", "close", "digest", "host", "path", "rule",
)
LONG = " ".join(f"w{i % 977}" for i in range(120_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (2, None),
    (3, ""),
    (4, " \t\n\r\v\f "),
    (5, "one"),
    (6, "two Words"),
    (7, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (7, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (8, LONG),
    (9, "É ü 漢字 😀 a\x00b tail"),
    (10, "x" * 5000),
    (None, "a row without an id, but with a few words in it"),
    (None, None),
]


def documents(spark, rows=TEXTS):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df = df.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")})
    return df.withColumns({name: F.lit(f"extra {name}") for name in EXTRA})


def pages(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.withColumns({name: F.lit(f"extra {name}") for name in EXTRA})


def lower_words(value, pattern=WORD):
    return pattern.findall((value or "").translate(LOWER))


def rows_of(df):
    return sorted(df.collect(), key=repr)
