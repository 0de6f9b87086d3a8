"""Toxicity by weak supervision: voters, a label model, and a classifier on its posterior labels.

1. Voters look at a text and fire or stay silent. Some are lists: public seed words, and words and
   word beginnings that rated training texts show to go with toxicity, dealt over several lists.
   Others are patterns: an insult near an address, shouting, exclamation, disguised spelling, several
   insults.
2. The label model is generative: a hidden class, and for each voter how often it fires in either
   class, estimated by expectation maximisation from the votes on all training texts. Voters that
   still agree within a class are correlated, and each then counts for less than a whole vote.
3. A linear classifier on the words and word beginnings of a text is trained on the posterior labels
   and scores all rows.

Labels serve to find features, and the share of toxic texts; the votes of all training texts are
counted, rated or not. Votes are one of 2^m patterns, at most 2^16 numbers. The rated sample
(``MAX_RATED``) and the classifier's sample (``MAX_TRAINING``) are the rows of smallest id hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import storage, text

MAX_RATED = 8_000
MAX_TRAINING = 8_000

#: Insults that a voter looks for without any training.
SEED = (
    "idiot", "moron", "stupid", "scum", "loser", "pathetic", "worthless", "disgusting", "trash",
    "dumpf", "abschaum", "arschloch", "connard", "salaud", "imbécile", "estúpido", "imbécil", "basura",
)
ADDRESS = ("you", "your", "u", "du", "dein", "ihr", "tu", "vous", "eres", "usted")

#: A word counts as a whole and by its beginnings of so many characters.
STEMS = (3, 4, 5, 6, 7)

#: Lists that the learned features are dealt over, and how many are learned.
LISTS, LEARNED = 8, 96

#: A learned feature occurs in so many texts, and at least this share of them is toxic: among rated
#: texts, and in the classifier's sample, half of which is toxic.
LEAST_TEXTS, LEAST_PRECISION, BALANCED_PRECISION = 5, 0.85, 0.9
NEAR = 4
PATTERNS = ("address", "shouting", "exclamation", "disguise", "several")
MAX_FEATURES = 256

#: Texts of usual votes that each class has to begin with.
PRIOR_TEXTS = 4.0
RIDGE = 1e-4

_DISGUISE = bytes.maketrans(b"013457", b"oieast")


@dataclass
class Model:
    prior: float
    accuracies: np.ndarray
    features: np.ndarray  # hashes, in order
    weights: np.ndarray
    intercept: float


def stems(different: pa.BinaryArray) -> np.ndarray:
    """A row of hashes for each word: the whole, then its beginnings; 0 where it is too short."""
    part = text.raw(different)
    length = np.diff(part.offsets)
    place = np.arange(len(part.data)) - np.repeat(part.offsets[:-1], length)
    powers = text._powers(int(length.max(initial=0)) + 1)
    total = np.zeros(len(part.data) + 1, np.uint64)
    np.cumsum((part.data.astype(np.uint64) + np.uint64(1)) * powers[place], out=total[1:])
    begin = total[part.offsets[:-1]]
    out = np.zeros((len(length), 1 + len(STEMS)), np.uint64)
    out[:, 0] = text.mix(total[part.offsets[1:]] - begin)
    heads = np.flatnonzero((part.data & 0xC0) != 0x80)
    first = np.searchsorted(heads, part.offsets)
    edge = np.append(heads, len(part.data))
    for column, k in enumerate(STEMS, 1):
        long_ = np.flatnonzero(np.diff(first) >= k)
        cut = edge[first[long_] + k]
        out[long_, column] = text.mix(total[cut] - begin[long_] + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return out


def _parents(hashed: np.ndarray) -> np.ndarray:
    """For each hash that ``stems`` gives, that of the next shorter beginning; 0 where there is none."""
    out = np.zeros_like(hashed)
    out[:, 2:] = hashed[:, 1:-1]
    longest = (hashed[:, 1:] != 0).sum(1)
    out[:, 0] = np.where(longest > 0, hashed[np.arange(len(hashed)), longest], 0)
    return out


def _tokens(part: text.Raw) -> tuple[text.Words, np.ndarray, pa.BinaryArray, np.ndarray]:
    """Words, their codes, the different words, and the hashes of these as wholes and beginnings."""
    w = text.words(part, text.ALNUM_LOWER)
    different, codes = w.coded()
    return w, codes, different, stems(different)


def _presence(w: text.Words, codes: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and word of each word that a text holds, once."""
    key = np.sort(w.text_of() * np.int64(max(kinds, 1)) + codes)
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return key // max(kinds, 1), key % max(kinds, 1)


def _features(w: text.Words, codes: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and feature of each feature that a text holds, once."""
    doc, word = _presence(w, codes, len(hashed))
    row = np.repeat(doc, hashed.shape[1])
    feature = hashed[word].ravel()
    row, feature = row[feature != 0], feature[feature != 0]
    order = np.argsort(feature, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    row, feature = row[order], feature[order]
    new = np.append(True, (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])) if len(row) else np.zeros(0, bool)
    return row[new], feature[new]


def mined(rated: DataFrame, most: int, precision: float) -> np.ndarray:
    """Hashes of the features that occur in the most toxic texts and almost only there, in this
    order. ``rated`` has toxic and text. A feature that occurs in the same texts as the next shorter
    beginning is left out for that; a word that has one occurs there only, so equal counts tell it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in text.slices(batch["text"], text.SLICE_BYTES // 4):
                toxic = batch["toxic"].slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
                w, codes, _, hashed = _tokens(part)
                doc, feature = _features(w, codes, hashed)
                order = np.argsort(feature, kind="stable")
                feature, hit = feature[order], toxic[doc[order]]
                new = np.flatnonzero(np.append(True, feature[1:] != feature[:-1])) if len(feature) else np.zeros(0, int)
                total = np.diff(np.append(new, len(feature)))
                hits = np.add.reduceat(hit, new) if len(new) else total
                kinds, at = np.unique(hashed, return_index=True)
                parent = _parents(hashed).ravel()[at[np.searchsorted(kinds, feature[new])]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(feature[new].view(np.int64)),
                        pa.array(parent.view(np.int64)),
                        pa.array(hits),
                        pa.array(total - hits),
                    ],
                    ["feature", "parent", "toxic", "clean"],
                )

    counts = rated.select("toxic", "text").mapInArrow(run, "feature bigint, parent bigint, toxic bigint, clean bigint")
    counts = counts.groupBy("feature").agg(
        F.min("parent").alias("parent"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    pure = F.col("toxic") >= precision * (F.col("toxic") + F.col("clean"))
    counts = counts.filter((F.col("toxic") >= LEAST_TEXTS) & pure)
    counts = storage.written(counts, "features")
    shorter = counts.select(F.col("feature").alias("parent"), "toxic", "clean")
    counts = counts.join(shorter, ["parent", "toxic", "clean"], "left_anti")
    best = counts.orderBy(F.desc(F.col("toxic") - 3 * F.col("clean")), "clean", "feature").limit(most)
    return np.array([row["feature"] for row in best.collect()], np.int64).view(np.uint64)


def voter_lists(learned: np.ndarray) -> list[np.ndarray]:
    """Hashed lists: the seed, then the learned features dealt out by rank."""
    seed = stems(pa.array([s.encode() for s in SEED], pa.binary()))[:, 0]
    return [np.sort(seed), *(np.sort(learned[i::LISTS]) for i in range(LISTS))]


def votes(part: text.Raw, lists: list[np.ndarray]) -> np.ndarray:
    """The voters that fire on each text, as bits: lists first, then ``PATTERNS``."""
    w, codes, different, hashed = _tokens(part)
    n = len(part)
    doc = w.text_of()
    fired = np.zeros(n, np.int64)

    def vote(bit: int, texts: np.ndarray) -> None:
        fired[texts] |= 1 << bit

    insult = np.zeros(len(different), bool)
    for bit, words in enumerate(lists):
        held = np.isin(hashed, words).any(1)
        insult |= held
        vote(bit, doc[held[codes]])
    bit = len(lists)
    at = np.flatnonzero(insult[codes])
    calls = np.flatnonzero(np.isin(hashed[:, 0], stems(pa.array([a.encode() for a in ADDRESS], pa.binary()))[:, 0])[codes])
    if len(at) and len(calls):
        for side in (np.searchsorted(calls, at) - 1, np.searchsorted(calls, at)):
            near = calls[np.clip(side, 0, len(calls) - 1)]
            close = (np.abs(near - at) <= NEAR) & (doc[near] == doc[at])
            vote(bit, doc[at[close]])
    upper = (part.data >= 0x41) & (part.data <= 0x5A)
    lower = (part.data >= 0x61) & (part.data <= 0x7A)
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[part.offsets])
    vote(bit + 1, np.flatnonzero((per_text(upper) > per_text(lower)) & (w.counts >= 3)))
    vote(bit + 2, np.flatnonzero(per_text(part.data == 0x21) * 4 > np.maximum(w.counts, 1)))
    mixed = [i for i, x in enumerate(different.to_pylist()) if x.isascii() and not x.isalpha() and not x.isdigit()]
    if mixed:
        plain = stems(pa.array([different[i].as_py().translate(_DISGUISE) for i in mixed], pa.binary()))
        known = np.zeros(len(different), bool)
        known[mixed] = np.isin(plain, np.concatenate(lists)).any(1)
        vote(bit + 3, doc[known[codes]])
    texts, _ = _presence(*_only(w, codes, insult), len(different))
    vote(bit + 4, np.flatnonzero(np.bincount(texts, minlength=n) >= 2))
    return fired


def _only(w: text.Words, codes: np.ndarray, chosen: np.ndarray) -> tuple[text.Words, np.ndarray]:
    """The words chosen by kind."""
    held = chosen[codes]
    before = np.concatenate([[0], np.cumsum(held)])
    return text.Words(w.data, np.arange(before[-1] + 1), before[w.first]), codes[held]


@dataclass
class LabelModel:
    prior: float
    fires: np.ndarray  # voter x class
    weight: np.ndarray  # what a voter's vote counts, less than one if it is correlated with others

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        bits = (patterns[:, None] >> np.arange(len(self.weight)) & 1).astype(float)
        on, off = np.log(self.fires), np.log1p(-self.fires)
        gain = bits * (on[:, 1] - on[:, 0]) + (1 - bits) * (off[:, 1] - off[:, 0])
        odds = gain @ self.weight + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def label_model(patterns: np.ndarray, counts: np.ndarray, voters: int, prior: float, rounds: int = 40) -> LabelModel:
    """Firing rates of all voters in both classes, from patterns of votes and their counts."""
    bits = (patterns[:, None] >> np.arange(voters) & 1).astype(float)
    prior = min(max(prior, 1e-3), 0.5)
    usual = (counts @ bits + 0.5) / (counts.sum() + 1.0)
    weight = np.ones(voters)
    # To begin with the lists are believed; patterns earn their part.
    q = np.where(bits[:, : voters - len(PATTERNS)].any(1), 0.9, 0.1 * prior)
    for outer in range(2):
        for _ in range(rounds):
            fires = np.stack([counts * p @ bits + PRIOR_TEXTS * usual for p in (1 - q, q)], 1)
            fires /= np.array([(counts * p).sum() + PRIOR_TEXTS for p in (1 - q, q)])
            model = LabelModel(prior, np.clip(fires, 1e-6, 1 - 1e-6), weight)
            q = model.posterior(patterns)
        if outer == 0:
            weight = 1 / (1 + _agreement(bits, counts, q))
    return model


def _agreement(bits: np.ndarray, counts: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For each voter the sum of its squared correlations with the others among toxic texts."""
    share = counts * q
    share = share / max(share.sum(), 1e-12)
    centred = bits - share @ bits
    cov = (centred * share[:, None]).T @ centred
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    alike = np.clip(cov / np.outer(sd, sd), 0, 1) ** 2
    np.fill_diagonal(alike, 0)
    return alike.sum(1)


def classifier(x: np.ndarray, q: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights of features, and an intercept, fitted to soft labels by Newton steps; the sample's
    share of toxic texts is traded for the prior."""
    x = np.concatenate([x, np.ones((len(q), 1))], 1)
    beta = np.zeros(x.shape[1])
    ridge = np.full(len(beta), RIDGE * len(q))
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (q - p) - ridge * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-6), gradient)
        beta += np.clip(step, -2, 2)
    share = min(max(q.mean(), 1e-3), 1 - 1e-3) if len(q) else prior
    return beta[:-1], float(beta[-1] + np.log(prior / (1 - prior)) - np.log(share / (1 - share)))


def _sampled(chosen: DataFrame, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the features each text of the sample holds, and its soft label."""
    shipped = chosen.sparkSession.sparkContext.broadcast(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in text.slices(batch["text"]):
                held = _held(part, shipped.value)
                lists = pa.array([np.flatnonzero(row).astype(np.int32) for row in held], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch["q"].slice(a, b - a), lists], ["q", "features"])

    rows = chosen.mapInArrow(run, "q double, features array<int>").toArrow().to_pydict()
    order = sorted(range(len(rows["q"])), key=lambda i: (rows["q"][i], rows["features"][i]))
    x = np.zeros((len(order), len(features)))
    for i, k in enumerate(order):
        x[i, rows["features"][k]] = 1
    return x, np.array([rows["q"][k] for k in order])


def _held(part: text.Raw, features: np.ndarray) -> np.ndarray:
    """Text x feature: which of the features, given in order, each text holds."""
    out = np.zeros((len(part), len(features)), bool)
    if not len(features):
        return out
    w, codes, _, hashed = _tokens(part)
    at = np.minimum(np.searchsorted(features, hashed), len(features) - 1)
    known = features[at] == hashed
    doc = w.text_of()
    used = known.any(1)[codes]
    doc, codes = doc[used], codes[used]
    row, column = np.nonzero(known[codes])
    out[doc[row], at[codes[row], column]] = True
    return out


def fit(docs: DataFrame, labels: DataFrame, training: Column, label: str = "toxic") -> Model:
    """A model from the rows of ``docs`` and ``labels`` that ``training``, a condition on doc_id,
    holds for.

    Rows without id or text teach nothing, nor labels other than 0 and 1; an id rated more than once
    counts as toxic if it is so once. Without ratings only the seed list and the patterns vote.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).dropna().filter(training)
    rated = labels.select("doc_id", F.col(label).cast("int").alias("toxic")).dropna().filter(training)
    rated = rated.filter("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rated = storage.written(rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_RATED), "rated")
    # At most MAX_RATED rows of two numbers are broadcast.
    learned = mined(docs.join(F.broadcast(rated), "doc_id"), LEARNED, LEAST_PRECISION)
    share = rated.agg(F.avg("toxic")).first()[0]
    lists = voter_lists(learned)
    shipped = docs.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in text.slices(batch["text"]):
                fired = pa.array(votes(part, shipped.value))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), fired], ["doc_id", "pattern"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    voted = storage.written(docs.mapInArrow(run, f"doc_id {kind}, pattern bigint"), "votes")
    counted = voted.groupBy("pattern").count().orderBy("pattern").toArrow()
    patterns, counts = counted["pattern"].to_numpy(), counted["count"].to_numpy().astype(float)
    model = label_model(patterns, counts, len(lists) + len(PATTERNS), 0.1 if share is None else share)
    q = model.posterior(patterns)
    table = docs.sparkSession.createDataFrame(
        list(zip(patterns.tolist(), q.tolist(), strict=True)), "pattern bigint, q double"
    )
    # At most 2^16 patterns, and MAX_TRAINING sampled ids, are broadcast.
    scored = voted.join(F.broadcast(table), "pattern")
    half = lambda rows: rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAINING // 2)
    chosen = half(scored.filter("q >= 0.5")).unionAll(half(scored.filter("q < 0.5"))).groupBy("doc_id").agg(F.max("q").alias("q"))
    sample = docs.join(F.broadcast(chosen), "doc_id").select("q", "text").limit(MAX_TRAINING)
    sample = storage.written(sample, "sample")
    features = np.sort(mined(sample.withColumn("toxic", F.expr("int(q >= 0.5)")), MAX_FEATURES, BALANCED_PRECISION))
    weights, intercept = classifier(*_sampled(sample, features), model.prior)
    rates = model.prior * model.fires[:, 1]
    return Model(model.prior, rates / (rates + (1 - model.prior) * model.fires[:, 0]), features, weights, intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` (1 from 0.5 on) for each row.

    A null or empty text has no word and gets the score of the intercept alone.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.intercept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, intercept = shipped.value
        for batch in batches:
            for a, b, part in text.slices(batch["text"]):
                odds = _held(part, features) @ weights + intercept
                value = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(a, b - a), pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int"
    )
