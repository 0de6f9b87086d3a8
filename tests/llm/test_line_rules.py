import odd
import pyarrow as pa

from kpiloom.llm import line_rules, text

GOOD = "This line of ten good words is kept as it is."


def judge(*texts):
    return line_rules.judge(text.raw(pa.array(texts)), line_rules.Rules())


def test_rules_judge_single_lines():
    bad = ["a### b$$$ c%%% d***", "Home | News | About | More", "BUY NOW!! TODAY!! CHEAP!!", "Menu", "Licensed under the Apache License, Version 2.0.", GOOD]
    j = judge("\n".join([GOOD, *bad, "", "  "]))
    assert j.line_kept.tolist() == [True, False, False, False, False, False, False, True, True]
    assert j.n_dup_lines.tolist() == [1] and j.kept_words.tolist() == [11]


def test_documents_that_lose_too_much_go():
    other = "Another line of as many words stands here as well."
    j = judge("\n".join([GOOD, other, "A | B | C | D"]), "\n".join([GOOD, "X | " * 30]), GOOD)
    assert j.kept.tolist() == [True, False, True]


def test_a_phrase_fails_short_lines_only():
    notice = "Read our privacy policy."
    long = " ".join(f"word{i}" for i in range(1500)) + ". " + notice
    edge = " ".join(f"word{i}" for i in range(46)) + " " + notice  # 50 words
    j = judge(long, edge, "word46 " + edge, notice)
    assert j.line_kept.tolist() == [True, False, True, False]
    assert j.kept.tolist() == [True, False, True, False]


def test_repeated_words_cover_their_windows():
    w = "a b c d e x a b c d e f y a b c d".split()
    codes = {x: k for k, x in enumerate(dict.fromkeys(w))}
    import numpy as np

    got = line_rules.repeated_words(np.array([codes[x] for x in w]), np.array([0, len(w)]), 5)
    assert got.tolist() == [10]


def test_cleaned_documents_keep_their_columns(spark):
    rows = [(1, GOOD + "\nMenu\n\n" + GOOD.replace("ten", "more")), (2, "A | B | C | D | E | F | G | H | I | J"), *odd.TEXTS]
    docs = odd.documents(spark, rows)
    kept = line_rules.cleaned(docs)
    assert kept.columns == docs.columns and kept.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    got = {r["doc_id"]: r for r in kept.collect()}
    assert got[1]["text"] in (GOOD + "\n\n" + GOOD.replace("ten", "more"), odd.TEXTS[0][1])
    assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and 2 not in got
    assert line_rules.cleaned(odd.documents(spark, [])).count() == 0


def test_odd_rows(spark):
    got = line_rules.measure(odd.documents(spark)).collect()
    assert len(got) == len(odd.TEXTS)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(by_id[i]["n_words"] == 0 and by_id[i]["base_failed"] and not by_id[i]["kept"] for i in (2, 3, 4))
    assert by_id[9]["word_chars"] == sum(map(len, odd.WORD.findall(dict(odd.TEXTS)[9]))) and by_id[8]["n_words"] == 120_000
    assert line_rules.measure(odd.documents(spark, [])).count() == 0
