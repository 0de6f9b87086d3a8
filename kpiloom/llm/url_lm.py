"""URL filter by the ratio of two character language models, in DataFrame operations only.

Rules allow or block hosts with their subdomains, from a path on; the longest rule that fits decides.
URLs that no rule fits are judged by two smoothed variable-order Markov models, counted over all
URLs that rules allow and block: the probability of a character after the ``ORDER`` characters before
it is interpolated with that after shorter contexts, down to uniform (Witten-Bell: a context seen n
times with d different followers keeps n / (n + d) for itself). The score is the difference of both
log likelihoods per character. Rates of both models enter the calibration: on a fold that the
counts leave out, the threshold is put where the scores of either side are equally many standard
deviations away.

URLs are reduced to their different (host, path) pairs before strings are cut, and each pair counts
as often as it occurs, in the models and in the calibration; each different string of ORDER + 1
characters has one weight. Weights are joined to strings by key; what is broadcast is
left to the engine's size check, and hot strings to its handling of skewed joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm import storage

ORDER = 3

#: Characters that a model tells apart: all that occur share this many.
ALPHABET = 96

#: One in so many URLs under a rule is left to the calibration.
FOLDS = 5
_START = "\u0002"
_END = "\u0003"


def parts(url: str) -> dict[str, Column]:
    """Host and path: what stands behind the first ``://``, the host up to ``/``, ``?``, ``#`` or the
    end with A-Z in lower case, the path then up to ``?``, ``#`` or the end; both empty for null and
    without ``://``."""
    rest = F.expr(f"if(instr({url}, '://') > 0, substring({url}, instr({url}, '://') + 3), '')")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(
        F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return {"host": host, "path": F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)}


def matched(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in sorted(rules, key=lambda r: (len(r), r)):
        own_host, _, own_path = name.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + own_path)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, rules[name]).otherwise(verdict)
    return rule, verdict


def _strings(urls: DataFrame, *columns: str) -> DataFrame:
    """A row for each character of a URL and the end: the character with those before it."""
    padded = F.concat(F.lit(_START * ORDER), F.col("host"), F.col("path"), F.lit(_END))
    cut = F.expr(f"transform(sequence(1, length(padded) - {ORDER}), i -> substring(padded, i, {ORDER + 1}))")
    return urls.withColumn("padded", padded).select(*columns, F.explode(cut).alias("gram"))


def _mean(value: Column) -> Column:
    """The mean of a value that is not null, each row as often as ``times`` says."""
    return F.try_divide(F.sum(value * F.col("times")), F.sum(F.when(value.isNotNull(), F.col("times"))))


def weights(counts: DataFrame) -> DataFrame:
    """``gram`` and ``weight``, the difference of the log probabilities of its last character under
    both models, from ``gram``, ``n_allow`` and ``n_block``."""
    below = None
    for size in range(1, ORDER + 2):
        if size <= ORDER:
            level = counts.groupBy(F.expr(f"right(gram, {size})").alias("gram")).agg(
                F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block")
            )
        else:
            level = counts
        context = Window.partitionBy(F.expr(f"left(gram, {size - 1})"))
        if below is None:
            level = level.withColumns({"low_allow": F.lit(1.0 / ALPHABET), "low_block": F.lit(1.0 / ALPHABET)})
        else:
            lower = below.select(F.col("gram").alias("tail"), F.col("p_allow").alias("low_allow"), F.col("p_block").alias("low_block"))
            level = level.withColumn("tail", F.expr(f"right(gram, {size - 1})")).join(lower, "tail").drop("tail")
        for side in ("allow", "block"):
            n = F.col(f"n_{side}")
            total = F.sum(n).over(context)
            kinds = F.sum(F.when(n > 0, 1).otherwise(0)).over(context)
            low = F.col(f"low_{side}")
            p = F.when(total > 0, F.try_divide(n + kinds * low, total + kinds)).otherwise(low)
            level = level.withColumn(f"p_{side}", p)
        below = level.select("gram", "n_allow", "n_block", "p_allow", "p_block")
    return below.select("gram", (F.log("p_allow") - F.log("p_block")).alias("weight"))


def judge(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``score`` of every row.

    ``rules`` maps ``host/path`` to allow or block. Rows of one host and path get one verdict. A null
    url, or one without ``://``, has an empty host and path and is judged as such. If either side has
    no URL under a rule, nothing can be told apart and URLs without a rule are allowed. Only page_id
    and url are read.
    """
    source = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumns(parts("url"))
    source = source.select("page_id", "host", "path")
    different = source.groupBy("host", "path").agg(F.count(F.lit(1)).alias("times"))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    fold = F.pmod(F.xxhash64("host", "path"), F.lit(FOLDS))
    urls = storage.written(different.withColumns({"rule": rule, "ruled": verdict, "fold": fold}), "urls")

    counted = _strings(urls, "ruled", "fold", "times")
    times = lambda side: F.when((F.col("ruled") == side) & (F.col("fold") > 0), F.col("times")).otherwise(0)
    tally = {f"n_{side}": F.sum(times(side)) for side in ("allow", "block")}
    grams = storage.written(counted.groupBy("gram").agg(*(c.alias(n) for n, c in tally.items())), "strings")
    weight = storage.written(weights(grams), "weights")
    # Rules decide for themselves: only URLs without one, and the calibration fold, are scored.
    scored = urls.filter(F.col("ruled").isNull() | (F.col("fold") == 0))
    scores = _strings(scored, "host", "path", "ruled", "times").join(weight, "gram")
    scores = scores.groupBy("host", "path", "ruled", "times").agg(F.avg("weight").alias("score"))
    scores = storage.written(scores, "scores")
    fitted = scores.filter("ruled is not null").groupBy("ruled").agg(_mean(F.col("score")).alias("mean"))
    means = dict(fitted.collect())
    sides = {}
    for side in ("allow", "block"):
        mean = F.lit(means.get(side)).cast("double")
        apart = F.when(F.col("ruled") == side, (F.col("score") - mean) ** 2)
        sides |= {f"mean_{side}": F.any_value(mean), f"sd_{side}": F.sqrt(_mean(apart))}
    fitted = scores.agg(*(c.alias(n) for n, c in sides.items()))
    spread = F.col("sd_allow") + F.col("sd_block")
    between = (F.col("mean_allow") * F.col("sd_block") + F.col("mean_block") * F.col("sd_allow"))
    middle = (F.col("mean_allow") + F.col("mean_block")) / 2
    threshold = F.when(spread > 0, F.try_divide(between, spread)).otherwise(middle)
    limit = fitted.select(threshold).first()[0]
    limit = F.lit(float("-inf") if limit is None else limit)
    own = scores.filter("ruled is null").select("host", "path", "score")
    verdicts = urls.join(own, ["host", "path"], "left")
    by_score = F.when(F.coalesce(F.col("score"), F.lit(0.0)) >= limit, "allow").otherwise("block")
    verdicts = verdicts.select("host", "path", "rule", F.coalesce("ruled", by_score).alias("verdict"), "score")
    return source.join(verdicts, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "score")
