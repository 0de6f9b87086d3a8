import numpy as np
import odd
import pyarrow as pa

from kpiloom.llm import text, weak_toxicity


def texts(n, seed=2):
    draw = np.random.default_rng(seed)
    out = []
    for i in range(n):
        toxic = int(draw.random() < 0.2)
        words = [f"word{draw.integers(300)}" for _ in range(30)]
        if toxic:
            for k in draw.choice(30, 3, replace=False):
                words[k] = f"zork{'abcdef'[draw.integers(6)]}{draw.integers(9)}" if draw.random() < 0.5 else "glorb"
        out.append((i, " ".join(words), toxic))
    return out


def test_held_out_texts_are_told_apart(spark):
    rows = texts(600)
    docs = odd.documents(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(None, 1), (1, None), (2, 7)], "doc_id bigint, toxic int")
    model = weak_toxicity.fit(docs, labels, text.remainder("doc_id", 5) != 0)
    fold = {r["doc_id"] for r in docs.filter(text.remainder("doc_id", 5) == 0).collect()}
    got = {r["doc_id"]: r for r in weak_toxicity.score(docs, model).collect()}
    held = [(x, got[i]["predicted"]) for i, _, x in rows if i in fold]
    assert np.mean([p for x, p in held if x]) > 0.9 and np.mean([p for x, p in held if not x]) < 0.05


def test_registered_query_on_the_tables(spark):
    from kpiloom.llm.queries import op8_toxicity

    src = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{src}/labels.parquet").collect()}
    held = [r for r in op8_toxicity(spark, src).collect() if r["held_out"] and r["doc_id"] in toxic]
    assert np.mean([r["predicted"] for r in held if toxic[r["doc_id"]]]) > 0.6
    assert np.mean([r["predicted"] for r in held if not toxic[r["doc_id"]]]) < 0.01


def test_label_model_finds_good_voters():
    draw = np.random.default_rng(7)
    voters = 4 + len(weak_toxicity.PATTERNS)
    y = draw.random(20_000) < 0.15
    rates = np.array([(0.8, 0.001), (0.6, 0.002), (0.5, 0.001), (0.7, 0.01)] + [(0.1, 0.1)] * len(weak_toxicity.PATTERNS))
    fires = draw.random((len(y), voters)) < np.where(y[:, None], rates[:, 0], rates[:, 1])
    codes, counts = np.unique(fires @ (1 << np.arange(voters)), return_counts=True)
    model = weak_toxicity.label_model(codes, counts.astype(float), voters, 0.15)
    assert np.abs(model.fires[:4] - rates[:4, ::-1]).max() < 0.05
    q = dict(zip(codes.tolist(), model.posterior(codes)))
    guess = np.array([q[c] >= 0.5 for c in (fires @ (1 << np.arange(voters))).tolist()])
    assert (guess == y).mean() > 0.95


def test_correlated_voters_count_for_less():
    draw = np.random.default_rng(8)
    voters = 4 + len(weak_toxicity.PATTERNS)
    y = draw.random(20_000) < 0.2
    fires = draw.random((len(y), voters)) < np.where(y[:, None], 0.5, 0.02)
    fires[:, 1] = fires[:, 0]
    fires[:, 4:] = draw.random((len(y), voters - 4)) < 0.01
    codes, counts = np.unique(fires @ (1 << np.arange(voters)), return_counts=True)
    weight = weak_toxicity.label_model(codes, counts.astype(float), voters, 0.2).weight
    assert weight[0] < 0.6 and weight[1] < 0.6 and weight[2] > 0.8


def test_pattern_votes():
    lists = weak_toxicity.voter_lists(np.zeros(0, np.uint64))
    cases = ["you are such an idiot", "an idiot " + "x " * 20 + "you", "SHOUTING ALL DAY LONG", "no! no! no! no!", "what an 1d10t", "moron and loser", "calm words only"]
    got = weak_toxicity.votes(text.raw(pa.array(cases)), lists)
    names = ["seed", *(f"list{i}" for i in range(weak_toxicity.LISTS)), *weak_toxicity.PATTERNS]
    fired = [{n for k, n in enumerate(names) if v >> k & 1} for v in got.tolist()]
    assert fired == [{"seed", "address"}, {"seed"}, {"shouting"}, {"exclamation"}, {"disguise"}, {"seed", "several"}, set()]


def test_odd_rows_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = weak_toxicity.fit(odd.documents(spark), none, text.remainder("doc_id", 5) != 0)
    got = weak_toxicity.score(odd.documents(spark), model).collect()
    assert len(got) == len(odd.TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (2, 3, 4)}) == 1
    empty = odd.documents(spark, [])
    assert weak_toxicity.score(empty, weak_toxicity.fit(empty, none, text.remainder("doc_id", 5) != 0)).count() == 0


def test_words_of_equal_counts_are_all_learned(spark):
    words = ["clown", "moron", "zork", "glorb"]
    rows = [(1, f"{w} said item{i}{w}") for w in words for i in range(6)] + [(0, f"said item{i}") for i in range(20)]
    found = weak_toxicity.mined(spark.createDataFrame(rows, "toxic int, text string"), 96, 0.85)
    hashed = weak_toxicity.stems(pa.array([w.encode() for w in words], pa.binary()))
    # One feature for each word: its beginnings occur in the same texts.
    assert np.isin(hashed, found).sum(1).tolist() == [1] * len(words) and len(found) == len(words)


def test_words_of_the_same_texts_are_all_learned(spark):
    rows = [(1, f"clown moron no{i}") for i in range(6)] + [(0, f"clo mo no{i}") for i in range(20)]
    found = weak_toxicity.mined(spark.createDataFrame(rows, "toxic int, text string"), 96, 0.85)
    hashed = weak_toxicity.stems(pa.array([b"clown", b"moron"], pa.binary()))
    assert np.isin(hashed, found).any(1).all()
