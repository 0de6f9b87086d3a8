import numpy as np
import odd
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import text

TEXTS = st.lists(st.none() | st.text(st.sampled_from("aAbzZ é漢\n\t\x0b-9"), max_size=12), max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    for table, pattern in ((text.VISIBLE_LOWER, odd.WORD), (text.ALNUM_LOWER, odd.ALNUM)):
        w = text.words(text.raw(pa.array(texts, pa.string())), table)
        found = [bytes(x.as_py()).decode() for x in w.array()]
        assert [found[a:b] for a, b in zip(w.first[:-1], w.first[1:])] == [odd.lower_words(t, pattern) for t in texts]


@settings(max_examples=40, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_shingles_are_equal_iff_their_words_are(texts, width):
    w = text.words(text.raw(pa.array(texts, pa.string())), text.VISIBLE_LOWER)
    different, codes = w.coded()
    hashed, first = text.shingle_hashes(text.hashes(different)[codes], w.first, width)
    runs = []
    for t in texts:
        own = odd.lower_words(t)
        runs.append([tuple(own[k : k + width]) for k in range(max(len(own) - width + 1, min(len(own), 1)))])
    assert list(np.diff(first)) == [len(r) for r in runs]
    flat = [r for own in runs for r in own]
    assert len(set(flat)) == len(set(hashed.tolist())) == len(set(zip(flat, hashed.tolist())))


def test_slices_are_bounded_and_whole():
    array = pa.array(["a" * 10, None, "b" * 50, "", "c" * 5] * 3)
    parts = list(text.slices(array, 20))
    assert [p[0] for p in parts][1:] == [p[1] for p in parts][:-1] and parts[-1][1] == 15
    assert all(len(r.data) <= 20 or b - a == 1 or len(r.data) == 50 for a, b, r in parts)
