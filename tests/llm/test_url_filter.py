import math
import re
from collections import Counter, defaultdict

import odd
import pytest

from kpiloom.llm import url_lm
from kpiloom.llm.queries import URL_RULES, op2_url_filter

URLS = [
    "http://a.com/x?q", "HTTP://WWW.Example.COM/en/1#t", "https://m.example.com/en/2", "http://example.com/en", "http://b.net/es/3",
    "http://net/fr/", "http://xnet/fr/1", "http://com", "http://com/", "no scheme", "", None, "http://", "http://c.org?x=/y", "ftp://h.org/a#b?c",
    "http://é.org/ü", "http://" + "long." * 3000 + "org/p",
]


def by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0].translate(odd.LOWER)
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    best = None
    for rule in URL_RULES:
        own_host, own_path = rule.split("/", 1)
        if (host == own_host or host.endswith("." + own_host)) and path.startswith("/" + own_path):
            best = max(best or "", rule, key=len)
    return host, path, best


def test_rules_hold_for_subdomains_and_the_longest_wins(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(0, URLS[0], "h"), (None, URLS[1], None)]
    got = url_lm.judge(odd.pages(spark, rows), URL_RULES).collect()
    assert len(got) == len(rows)
    urls = {i: u for i, u, _ in rows}
    for r in got:
        host, path, rule = by_hand(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == URL_RULES[rule])


def test_weights_equal_interpolated_models(spark):
    allow, block = ["a.com/x", "ab.com/xy"], ["b.net/z", "ba.net/zz", "b.net/zy"]
    order, size = url_lm.ORDER, url_lm.ALPHABET
    cut = lambda u: [(s := "\2" * order + u + "\3")[i : i + order + 1] for i in range(len(u) + 1)]
    counts = defaultdict(lambda: [0, 0])
    for side, urls in enumerate((allow, block)):
        for u in urls:
            for g in cut(u):
                counts[g][side] += 1
    counts["zzzz"]

    def p(gram, side):
        below = 1 / size
        for k in range(1, order + 2):
            tally = Counter()
            for g, n in counts.items():
                if g[-k:][:-1] == gram[-k:][:-1] and n[side]:
                    tally[g[-1]] += n[side]
            if tally:
                below = (tally[gram[-1]] + len(tally) * below) / (sum(tally.values()) + len(tally))
        return below

    df = spark.createDataFrame([(g, *n) for g, n in counts.items()], "gram string, n_allow bigint, n_block bigint")
    for r in url_lm.weights(df).collect():
        assert r["weight"] == pytest.approx(math.log(p(r["gram"], 0) / p(r["gram"], 1)))


def test_model_tells_sides_apart_without_python(spark, src):
    allow = [(i, f"http://good{i % 40}.com/{i % 89}", "") for i in range(800)]
    block = [(1000 + i, f"http://bad{i % 40}.net/es/{i % 97}", "") for i in range(800)]
    free = [(2000 + i, f"http://good{i}.org/{i}", "") for i in range(40)] + [(3000 + i, f"http://bad{i}.org/es/{i}", "") for i in range(40)]
    df = url_lm.judge(odd.pages(spark, allow + block + free), URL_RULES)
    got = {r["page_id"]: r["verdict"] for r in df.collect()}
    assert all(got[i] == "allow" for i in range(2000, 2040)) and all(got[i] == "block" for i in range(3000, 3040))
    assert not re.search("Python|Pandas|Arrow", op2_url_filter(spark, src)._jdf.queryExecution().toString())


def test_empty_tables_and_one_side_only(spark):
    assert url_lm.judge(odd.pages(spark, []), URL_RULES).count() == 0
    assert [r["verdict"] for r in url_lm.judge(odd.pages(spark, [(1, "http://a.org/", None)]), URL_RULES).collect()] == ["allow"]


def test_urls_count_as_often_as_they_occur(spark, monkeypatch):
    seen, weights = [], url_lm.weights
    monkeypatch.setattr(url_lm, "weights", lambda counts: seen.append(counts) or weights(counts))
    rows = [(i, f"http://q{k}.com/", "") for k in range(20) for i in range(k + 1)] + [(0, "http://z.net/es/", "")]
    url_lm.judge(odd.pages(spark, rows), URL_RULES)
    fold = f"pmod(xxhash64(concat('q', id, '.com'), '/'), {url_lm.FOLDS})"
    taught = [r["id"] + 1 for r in spark.range(20).selectExpr("id", f"{fold} as fold").filter("fold > 0").collect()]
    counts = {r["gram"]: r["n_allow"] for r in seen[0].collect()}
    assert counts["\2" * url_lm.ORDER + "q"] == sum(taught) > len(taught) > 0


def test_means_weigh_rows(spark):
    rows = [(1.0, 3), (5.0, 1), (None, 9)]
    df = spark.createDataFrame(rows, "score double, times bigint")
    assert df.select(url_lm._mean(df["score"])).first()[0] == 2.0
