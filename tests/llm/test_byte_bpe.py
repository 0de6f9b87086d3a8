import hashlib
import random

import numpy as np
import odd
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import bpe
from kpiloom.llm.queries import op13_byte_bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})


def ids_of(packed):
    return np.frombuffer(packed, np.int32).tolist()


def lowest_pair_first(word, ranks):
    """A word's tokens by the rule: merge the pair of lowest rank, the leftmost of equals, until none is left."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=200, deadline=None)
@given(st.permutations([b"ab", b"bc", b"abc", b"ca", b"aa", b"aaa", b"cab", b"bca", b"abab", b"aab", b"cc", b"abca"]), st.lists(st.text("abcd", max_size=14), min_size=1, max_size=6))
def test_replay_keeps_the_order_of_each_word(merges, words):
    """Ranks in any order: also where a merge makes a pair of a lower rank than its own."""
    vocabulary = bpe.Vocabulary([bytes([b]) for b in range(256)] + merges, r"\S+|\s+")
    words = [w.encode() for w in words]
    assert [ids_of(x) for x in bpe.replay(words, vocabulary)] == [lowest_pair_first(w, vocabulary.ranks) for w in words]


def test_words_of_random_tokens_equal_the_library(vocabulary):
    draw = random.Random(5)
    short = [t for t in vocabulary.tokens if len(t) < 7]
    words = [b"".join(draw.choices(short, k=draw.randint(2, 25))) for _ in range(4000)] + [b"a" * n for n in range(1, 1200, 37)]
    single = library(vocabulary)._core_bpe.encode_single_piece
    for word, ids in zip(words, bpe.replay(words, vocabulary)):
        assert word in vocabulary.ranks or ids_of(ids) == single(word)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(max_size=40) | st.text(st.sampled_from(" \t\n 　'sdlveA1漢é😀"), max_size=30), max_size=6))
def test_texts_equal_the_library_and_come_back(texts):
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids, first = bpe.Encoder(vocabulary).encode(texts)
    encoding = library(vocabulary)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [encoding.encode_ordinary(t or "") for t in texts]
    assert bpe.decode_slice(vocabulary, ids, first).to_pylist() == [(t or "").encode() for t in texts]


def test_memory_and_corpus_bounds_change_nothing(vocabulary, monkeypatch):
    texts = [odd.LONG[:3000], "supercalifragilisticexpialidocious" * 5, odd.LONG[2000:6000], None, ""]
    want = bpe.Encoder(vocabulary).encode(texts)[0].tolist()
    for name, bound in (("CORPUS_BYTES", 10), ("MEMORY_WORDS", 3), ("MEMORY_CHARS", 2)):
        monkeypatch.setattr(bpe, name, bound)
    encoder = bpe.Encoder(vocabulary)
    assert [i for t in texts for i in encoder.encode([t])[0].tolist()] == want
    assert all(len(w) <= 2 for w in encoder.known)


def test_odd_rows(spark, vocabulary):
    docs = odd.documents(spark)
    coded = bpe.round_trip(docs, vocabulary)
    encoding = library(vocabulary)
    want = sorted(((i, encoding.encode_ordinary(t or ""), (t or "").encode()) for i, t in odd.TEXTS), key=repr)
    assert sorted(((r[0], r[1], bytes(r[2])) for r in coded.collect()), key=repr) == want
    assert bpe.round_trip(odd.documents(spark, []), vocabulary).count() == 0
    decoded = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    assert sorted(((r[0], r[1], bytes(r[2])) for r in decoded), key=repr) == want


def test_ids_outside_the_vocabulary_are_refused(spark, vocabulary):
    ids = spark.createDataFrame([(1, [50_256])], "doc_id bigint, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(ids, vocabulary).collect()
    nulls = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert bytes(bpe.decode(nulls, vocabulary).first()["decoded"]) == b""


def test_vocabulary_is_checked(tmp_path):
    with pytest.raises(ValueError):
        bpe.Vocabulary([b"a"], r"\S+")
    path = tmp_path / "ranks"
    path.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe.load(str(path), r"\S+")


def test_query_equals_the_library(spark, src, vocabulary):
    encoding = library(vocabulary)
    want = []
    for row in spark.read.parquet(f"{src}/documents.parquet").select("doc_id", "text").collect():
        ids = encoding.encode_ordinary(row["text"] or "")
        digest = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (row["text"] or "").encode())]
        want.append((row["doc_id"], len(ids), *digest))
    assert odd.rows_of(op13_byte_bpe(spark, src)) == sorted(want, key=repr)
