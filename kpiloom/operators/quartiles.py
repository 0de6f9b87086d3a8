"""Quartiles and fences of single deliveries from sketches of a supplier's days.

A day of a supplier is one KLL sketch of its lead times. Sketches of any set of days merge to that of all
their deliveries, so quartiles of a range, and the fences of a rolling baseline, are read from one
small row per supplier and day; the deliveries are scanned once. A sketch of up to ``K`` values is exact.
Beyond that a quantile's rank is off by ``RANK_ERROR`` (1.3 %) at most in 99 of 100 cases; the bound taken
here is three times that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions import checks
from kpiloom.functions.expressions import rounded
from kpiloom.operators import anomaly

K = 200
#: Published for KLL sketches: 2.296 / k^0.9723 (fixed values).
RANK_ERROR = 2.296 / K**0.9723
BOUND = 3 * RANK_ERROR
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def daily_sketches(deliveries: DataFrame) -> DataFrame:
    """``supplier_id``, ``date``, ``deliveries`` and ``sketch`` of their lead times (in days). Deliveries
    without a lead time are left out. A hot supplier is reduced on the map side."""
    known = deliveries.filter(F.col("lead_time_days").isNotNull())
    return known.groupBy("supplier_id", F.col("delivery_date").alias("date")).agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.kll_sketch_agg_bigint(F.col("lead_time_days").cast("bigint"), F.lit(K)).alias("sketch"),
    )


def _quartiles(sketch: str) -> list[Column]:
    return [F.kll_sketch_get_quantile_bigint(sketch, F.lit(at)).alias(name) for name, at in QUARTILES.items()]


def of_periods(sketches: DataFrame, period: Column) -> DataFrame:
    """Deliveries and quartiles per supplier and period, from the merged sketches of its days."""
    merged = sketches.groupBy("supplier_id", period.alias("period")).agg(
        F.sum("deliveries").alias("deliveries"), F.kll_merge_agg_bigint("sketch").alias("sketch")
    )
    return merged.select("supplier_id", "period", "deliveries", *_quartiles("sketch"))


def check(deliveries: DataFrame, period: Column) -> DataFrame:
    """Exact quartiles per supplier and period (of ``date``), and whether every sketched one has a rank
    within the bound: its share of smaller values, or that of values up to it, or a point between."""
    known = deliveries.filter(F.col("lead_time_days").isNotNull()).select(
        "supplier_id", F.col("delivery_date").alias("date"), F.col("lead_time_days").cast("bigint").alias("lead")
    )
    keys = ["supplier_id", "period"]
    # Lead times are few different values: counted first, the rest is small.
    counted = known.groupBy("supplier_id", period.alias("period"), "lead").agg(F.count(F.lit(1)).alias("n"))
    sketched = of_periods(daily_sketches(deliveries), period).drop("deliveries")
    exact = [F.expr(f"percentile_disc({at}) within group (order by lead)").alias(f"exact_{name}") for name, at in QUARTILES.items()]
    exact_rows = known.groupBy("supplier_id", period.alias("period")).agg(F.count(F.lit(1)).alias("deliveries"), *exact)
    below = [
        F.sum(F.when(F.col("lead") < F.col(name), F.col("n")).otherwise(0)).alias(f"under_{name}") for name in QUARTILES
    ] + [F.sum(F.when(F.col("lead") <= F.col(name), F.col("n")).otherwise(0)).alias(f"upto_{name}") for name in QUARTILES]
    ranks = counted.join(sketched, keys).groupBy(*keys).agg(*below)
    within = F.lit(True)
    for name, at in QUARTILES.items():
        target = F.lit(at) * F.col("deliveries")
        slack = F.lit(BOUND) * F.col("deliveries")
        within &= (F.col(f"under_{name}") - slack <= target) & (target <= F.col(f"upto_{name}") + slack)
    return exact_rows.join(ranks, keys).select(
        *keys, "deliveries", *(F.col(f"exact_{name}").cast("bigint").alias(name) for name in QUARTILES), within.alias("within_bound")
    )


def fences(sketches: DataFrame, lookback: int = anomaly.LOOKBACK, fence: float = anomaly.FENCE) -> DataFrame:
    """The quartiles and fences for each supplier day, from the deliveries on the ``lookback`` delivery
    days before it. A baseline of fewer than four deliveries has none.

    The window holds one sketch per day of a supplier.
    """
    checks.lookback(lookback)
    before = Window.partitionBy("supplier_id").orderBy("date").rowsBetween(-lookback, -1)
    based = sketches.select(
        "*", F.sum("deliveries").over(before).alias("based_on"), F.kll_merge_agg_bigint("sketch").over(before).alias("baseline")
    )
    enough = F.col("based_on") >= anomaly.MIN_POINTS_IQR
    q1, q3 = (F.when(enough, F.kll_sketch_get_quantile_bigint("baseline", F.lit(at))) for at in (0.25, 0.75))
    reach = fence * (F.col("q3") - F.col("q1"))
    return based.withColumn("q1", q1).withColumn("q3", q3).select(
        "supplier_id", "date", "deliveries", F.coalesce("based_on", F.lit(0)).cast("bigint").alias("based_on"), "q1", "q3",
        rounded(F.col("q1") - reach, 2).alias("low_fence"), rounded(F.col("q3") + reach, 2).alias("high_fence"),
    )


def outside(deliveries: DataFrame, by_day: DataFrame) -> DataFrame:
    """The single deliveries that lie outside the ``fences`` of their supplier's day, with these."""
    lead = F.col("lead_time_days")
    held = by_day.select("supplier_id", F.col("date").alias("delivery_date"), "q1", "q3", "low_fence", "high_fence")
    found = deliveries.join(held, ["supplier_id", "delivery_date"])
    return found.filter((lead < F.col("low_fence")) | (lead > F.col("high_fence")))
