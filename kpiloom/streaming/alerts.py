"""Alerts while a stream runs: hourly revenue against a stored baseline, stock against its reorder line.

Each is a step from one micro-batch to the next (``runner.run_carrying``): it takes the batch and a small
table that the batch before left behind, and leaves that table anew. Keyed state with timers is to be
had in this language with Python workers only, so the memory is a versioned table and its joins and
windows are built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.operators import anomaly

#: What the hourly step hands on: the hours that the next one is scored against.
BASELINE = "date timestamp, value double"

#: What the stock step hands on: the last known level of each product that was heard of lately.
LEVELS = "product_id bigint, stock_level int, seen timestamp, event_id bigint"

#: A product that was silent for longer is forgotten: its next level counts as its first.
SILENCE = "interval 7 days"


def score_hours(hours: DataFrame, baseline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Closed hours (``date``, ``value``) scored against the 30 before them, and the 30 newest hours.

    Hours close in order, so those of the baseline lie before all of the batch. The window holds the
    baseline and the batch's hours, one row each.
    """
    series = baseline.withColumn("is_new", F.lit(False)).unionByName(hours.withColumn("is_new", F.lit(True)))
    keys = {"domain": F.lit("ecommerce"), "metric": F.lit("hourly_revenue"), "entity": F.lit("")}
    scored = anomaly.score_zscore(series.select("*", *(value.alias(name) for name, value in keys.items())))
    fresh = scored.join(hours.select("date"), "date", "left_semi").drop(*keys)
    newest = series.orderBy(F.desc("date")).limit(anomaly.LOOKBACK).select("date", "value")
    return fresh, newest


def stock_step(levels: DataFrame, lines: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alerts of a batch of stock levels, and the levels known after it.

    ``levels``: product_id, stock_level, seen, event_id; ``lines``: product_id, product_name,
    reorder_point. An alert is a level below the line after one that was not, or after none: one when
    the line is crossed, the next only after the stock has recovered. It carries the level before and
    the change. A level older than the newest known of its product changes nothing; null levels are
    left out.

    Levels are put in order within a product's hour; from hour to hour only the last one counts. So a
    product that most events belong to is spread over its hours.
    """
    order = F.struct("seen", "event_id")
    last_known = known.select("product_id", F.col("seen").alias("known_seen"), F.col("event_id").alias("known_id"), F.col("stock_level").alias("known_level"))
    hour = F.date_trunc("hour", "seen")
    fresh = levels.filter(F.col("stock_level").isNotNull() & F.col("product_id").isNotNull() & F.col("seen").isNotNull())
    fresh = fresh.join(last_known, "product_id", "left").filter(
        F.col("known_seen").isNull() | (order > F.struct("known_seen", "known_id"))
    )
    fresh = fresh.select("product_id", "stock_level", "seen", "event_id", hour.alias("hour"))
    closing = fresh.groupBy("product_id", "hour").agg(F.max_by(F.struct("seen", "stock_level"), order).alias("closing"))
    at_start = known.select("product_id", F.lit(None).cast("timestamp").alias("hour"), F.struct("seen", "stock_level").alias("closing"))
    by_hour = Window.partitionBy("product_id").orderBy(F.col("hour").asc_nulls_first())
    opening = closing.unionByName(at_start).withColumn("opening", F.lag("closing").over(by_hour)).filter("hour is not null")
    in_hour = Window.partitionBy("product_id", "hour").orderBy("seen", "event_id")
    before = F.coalesce(F.lag(F.struct("seen", "stock_level")).over(in_hour), F.col("opening"))
    ordered = fresh.join(opening.select("product_id", "hour", "opening"), ["product_id", "hour"]).withColumn("before", before)
    silent = F.col("before.seen") + F.expr(SILENCE) < F.col("seen")
    previous = F.when(~silent, F.col("before.stock_level"))
    crossed = ordered.withColumn("previous_level", previous).join(lines, "product_id")
    below = F.col("stock_level") < F.col("reorder_point")
    alerts = crossed.filter(below & (F.col("previous_level").isNull() | (F.col("previous_level") >= F.col("reorder_point")))).select(
        "product_id",
        "product_name",
        "event_id",
        "seen",
        "previous_level",
        "stock_level",
        (F.col("stock_level") - F.col("previous_level")).alias("change_quantity"),
        "reorder_point",
    )
    return alerts, _remembered(known, fresh, order)


def _remembered(known: DataFrame, fresh: DataFrame, order: Column) -> DataFrame:
    """The newest level of each product, without those silent for too long before the newest of all."""
    columns = ["product_id", "stock_level", "seen", "event_id"]
    newest = known.select(*columns).unionByName(fresh.select(*columns)).groupBy("product_id")
    newest = newest.agg(F.max_by(F.struct("stock_level", "seen", "event_id"), order).alias("last")).select("product_id", "last.*")
    now = newest.agg(F.max("seen")).scalar()
    return newest.filter(F.col("seen") + F.expr(SILENCE) >= now)
