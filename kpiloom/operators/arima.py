"""ARIMA(1,1,1) by exact likelihood, its forecasts, and its residuals as anomalies.

The differences of a series follow d[t] = phi d[t-1] + e[t] + theta e[t-1]. Of the Kalman filter of that
model only two numbers change from day to day, the expected difference and its variance (in units
of the variance of e), so the filter is a fold of built-in functions over the differences of one entity:

    v = d - a      a' = phi d + theta v / f      f' = 1 + theta^2 - theta^2 / f

from a = 0 and the stationary f = (1 + 2 phi theta + theta^2) / (1 - phi^2). The variance of e is
concentrated out, which leaves n ln(sum v^2/f) + sum ln f to be minimised. The search goes over a
grid of a tenth and three times over a grid five times finer around the best point, both coefficients
staying within +-0.98; equal likelihoods go to the smaller coefficients. Each grid point is a row, so the
fit spreads over tasks whatever the number of entities. A history is 90 days at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.expressions import rounded
from kpiloom.operators import anomaly, forecast

#: Points of the first grid per unit, how much finer each further one is, and how many there are.
COARSE, FINER, REFINEMENTS = 10, 5, 3
#: Largest coefficient, in steps of the first refinement.
_BOUND = 49


def differences(daily: DataFrame, entity: str, value: str) -> DataFrame:
    """Per entity with enough days: ``dates`` and ``levels`` of its last days, oldest first, and ``d``,
    the difference that leads to each day but the first."""
    day = F.struct(-F.col("age"), "date", F.col(value).cast("double").alias("y"))
    return (
        forecast.last_days(daily, entity)
        .groupBy(entity)
        .agg(F.sort_array(F.collect_list(day)).alias("h"))
        .filter(F.size("h") >= forecast.MIN_DAYS)
        .select(entity, F.transform("h", lambda s: s["date"]).alias("dates"), F.transform("h", lambda s: s["y"]).alias("levels"))
        .withColumn(
            "d",
            F.transform(F.sequence(F.lit(2), F.size("levels")), lambda i: F.element_at("levels", i) - F.element_at("levels", i - 1)),
        )
    )


def _filter(phi: Column, theta: Column, steps: bool) -> Column:
    """The filter over ``d``: expected difference ``a`` and its variance ``f`` for the day to come, the
    sum ``s`` of v^2/f and the product ``p`` of all f; with ``steps`` also a and f of every day."""
    square = theta * theta
    start = {
        "a": F.lit(0.0),
        "f": (F.lit(1.0) + F.lit(2.0) * phi * theta + square) / (F.lit(1.0) - phi * phi),
        "s": F.lit(0.0),
        "p": F.lit(1.0),
    }
    if steps:
        start["days"] = F.array().cast("array<struct<a:double,f:double>>")

    def step(state: Column, d: Column) -> Column:
        v = d - state["a"]
        after = {
            "a": phi * d + theta * v / state["f"],
            "f": F.lit(1.0) + square - square / state["f"],
            "s": state["s"] + v * v / state["f"],
            "p": state["p"] * state["f"],
        }
        if steps:
            after["days"] = F.concat(state["days"], F.array(F.struct(state["a"].alias("a"), state["f"].alias("f"))))
        return F.struct(*(value.alias(name) for name, value in after.items()))

    return F.aggregate("d", F.struct(*(value.alias(name) for name, value in start.items())), step)


def log_likelihood(n: Column, s: Column, p: Column) -> Column:
    """Of the differences, at the best variance."""
    return -n / 2 * (F.lit(math.log(2 * math.pi)) + 1 + F.ln(s / n)) - F.ln(p) / 2


def fit(series: DataFrame, entity: str) -> DataFrame:
    """``series`` with the ``phi`` and ``theta`` of the largest likelihood."""
    steps = F.sequence(F.lit(1 - COARSE), F.lit(COARSE - 1))
    points = series.select("*", F.explode(steps).alias("i")).repartition(entity, "i").select("*", F.explode(steps).alias("j"))
    best = _best(points, entity, COARSE)
    per_unit, bound = COARSE, _BOUND
    for _ in range(REFINEMENTS):
        points = best.withColumn("i", F.explode(_around("i"))).withColumn("j", F.explode(_around("j")))
        per_unit *= FINER
        best = _best(points.filter((F.abs("i") <= bound) & (F.abs("j") <= bound)), entity, per_unit)
        bound *= FINER
    return best.withColumns({"phi": F.col("i") / F.lit(float(per_unit)), "theta": F.col("j") / F.lit(float(per_unit))}).drop("i", "j")


def _around(step: str) -> Column:
    """The finer steps up to the next coarse ones on both sides."""
    middle = FINER * F.col(step)
    return F.sequence(middle - FINER, middle + FINER)


def _best(points: DataFrame, entity: str, per_unit: int) -> DataFrame:
    phi, theta = (F.col(name) / F.lit(float(per_unit)) for name in ("i", "j"))
    run = points.withColumn("run", _filter(phi, theta, steps=False))
    spread = F.when(F.col("run.s") > 0, F.size("d") * F.ln("run.s")).otherwise(0.0)
    # Points on the line theta = -phi are equally likely; the last digits must not decide.
    cost = rounded(spread + F.ln("run.p"), 9)
    carried = [name for name in points.columns if name not in (entity, "i", "j")]
    least = F.min_by(F.struct(*carried, "i", "j"), F.struct("cost", "i", "j")).alias("best")
    return run.withColumn("cost", cost).groupBy(entity).agg(least).select(entity, "best.*")


def demand(daily: DataFrame, entity: str = "category", horizon_days: int = 30) -> DataFrame:
    """Forecast quantity of each entity and day ahead, with the coefficients and the likelihood."""
    fitted = fit(differences(daily, entity, "quantity"), entity)
    run = fitted.withColumn("run", _filter(F.col("phi"), F.col("theta"), steps=False))
    n = F.size("d").cast("double")
    likelihood = F.when(F.col("run.s") > 0, log_likelihood(n, F.col("run.s"), F.col("run.p")))
    phi = F.col("phi")
    value = F.col("last") + F.col("a") * (1 - F.pow(phi, F.col("day"))) / (1 - phi)
    return (
        run.select(
            entity, "phi", "theta", likelihood.alias("likelihood"), F.col("run.a").alias("a"),
            F.element_at("levels", -1).alias("last"), forecast._ahead(horizon_days),
        )
        .select(
            entity, "day", rounded(phi, 4).alias("phi"), rounded(F.col("theta"), 4).alias("theta"),
            rounded(F.col("likelihood"), 6).alias("log_likelihood"),
            rounded(forecast._floor_zero(value), 4).alias("forecasted_quantity"),
        )
    )


def residuals(daily: DataFrame, entity: str = "category", sigma: float = anomaly.SIGMA) -> DataFrame:
    """Each day of a history but the first: what the model expected from the days before, and the
    distance from that in standard deviations. Anomalous beyond ``sigma``; a series that the model
    meets exactly has distance 0."""
    fitted = fit(differences(daily, entity, "quantity"), entity)
    run = fitted.withColumn("run", _filter(F.col("phi"), F.col("theta"), steps=True))
    days = run.select(
        entity, "dates", "levels", "d", (F.col("run.s") / F.size("d")).alias("variance"), F.posexplode("run.days").alias("at", "step")
    )
    at = F.col("at")
    v = F.get("d", at) - F.col("step.a")
    z = F.coalesce(v / F.nullif(F.sqrt(F.col("variance") * F.col("step.f")), F.lit(0.0)), F.lit(0.0))
    scored = days.select(
        entity,
        F.get("dates", at + 1).alias("date"),
        F.get("levels", at + 1).alias("value"),
        rounded(F.get("levels", at) + F.col("step.a"), 4).alias("expected_value"),
        rounded(z, 6).alias("z_score"),
    )
    return scored.withColumn("is_anomaly", F.abs("z_score") > sigma)
