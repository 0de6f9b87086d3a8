"""Anomaly detection over long metric frames.

A metric frame has the columns ``domain, metric, entity, date, value``: one row per metric,
entity and day. Every row is scored against the rows before it in one window pass, so all
days of all metrics and entities are judged by a single job. A series is bounded by the
calendar; entities spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions import checks
from kpiloom.functions.expressions import double, or_zero, ratio, rounded

# Thresholds and alert texts.
LOOKBACK = 30
SIGMA = 2.0
DELIVERY_SIGMA = 1.5
CRITICAL_SIGMA = 3.0
FENCE = 1.5
MIN_POINTS_ZSCORE = 3
MIN_POINTS_IQR = 4
BUDGET_WARNING_PCT = 10
BUDGET_CRITICAL_PCT = 20
CONVERSION_ADVICE = "Check website performance, marketing campaigns, or customer experience issues."
DELIVERY_ADVICE = "Investigate supplier delays. Consider escalation or alternative suppliers."

SERIES = ["domain", "metric", "entity"]


def metric(df: DataFrame, domain: str, name: str, value: str, entity: Column | None = None) -> DataFrame:
    """One column of a daily frame as a metric frame; days without a value are left out."""
    return df.filter(F.col(value).isNotNull()).select(
        F.lit(domain).alias("domain"),
        F.lit(name).alias("metric"),
        (F.lit("") if entity is None else entity.cast("string")).alias("entity"),
        "date",
        double(value).alias("value"),
    )


def metrics(df: DataFrame, domain: str, columns: dict[str, str]) -> DataFrame:
    """Several columns of one daily frame, unpivoted in a single pass over it."""
    pairs = ", ".join(f"'{name}', cast({column} as double)" for name, column in columns.items())
    return df.selectExpr(
        f"'{domain}' as domain", "'' as entity", "date", f"stack({len(columns)}, {pairs}) as (metric, value)"
    ).filter("value is not null").select("domain", "metric", "entity", "date", "value")


def _baseline(lookback: int):
    return Window.partitionBy(*SERIES).orderBy("date").rowsBetween(-lookback, -1)


def score_zscore(
    series: DataFrame, sigma: float | Column = SIGMA, lookback: int = LOOKBACK, min_points: int = MIN_POINTS_ZSCORE
) -> DataFrame:
    """Score each row by its distance from the mean of the rows before it.

    Fewer than ``min_points`` rows: not anomalous, all zeros. A flat baseline: anomalous iff
    the value differs, with a null score (it would be infinite). Else anomalous iff
    ``abs(z) > sigma``, with the population deviation.
    """
    checks.lookback(lookback)
    frame = _baseline(lookback)
    scored = series.select(
        "*",
        F.count("value").over(frame).alias("points"),
        F.min("value").over(frame).alias("low"),
        F.max("value").over(frame).alias("high"),
        F.avg("value").over(frame).alias("raw_mean"),
        F.stddev_pop("value").over(frame).alias("raw_sd"),
    )
    known = F.col("points") >= min_points
    # Flatness and distance from a flat baseline are told from its extremes, which carry no
    # rounding error of the mean.
    flat = F.col("low") == F.col("high")
    differs = F.col("value") != F.col("low")
    mean = F.when(flat, F.col("low")).otherwise(F.col("raw_mean"))
    sd = F.when(flat, 0.0).otherwise(F.col("raw_sd"))
    z = (F.col("value") - mean) / F.nullif(sd, F.lit(0.0))
    return scored.select(
        *SERIES,
        "date",
        "value",
        "points",
        F.when(known, mean).otherwise(0.0).alias("mean"),
        F.when(known, sd).otherwise(0.0).alias("sd"),
        F.when(~known, 0.0).when(flat & differs, F.lit(None).cast("double")).when(flat, 0.0).otherwise(z).alias("z"),
        F.when(~known, False).when(flat, differs).otherwise(F.abs(z) > sigma).alias("is_anomaly"),
    )


def score_iqr(
    series: DataFrame, fence: float = FENCE, lookback: int = LOOKBACK, min_points: int = MIN_POINTS_IQR
) -> DataFrame:
    """Fences at ``fence`` quartile ranges around the quartiles (linear interpolation) of the
    rows before; anomalous iff strictly outside. Too few rows: fences 0 and null (no limit)."""
    checks.lookback(lookback)
    frame = _baseline(lookback)
    known = F.col("points") >= min_points
    spread = F.col("quartiles")[1] - F.col("quartiles")[0]
    low = F.col("quartiles")[0] - fence * spread
    high = F.col("quartiles")[1] + fence * spread
    return series.select(
        "*",
        F.count("value").over(frame).alias("points"),
        F.percentile("value", F.array(F.lit(0.25), F.lit(0.75))).over(frame).alias("quartiles"),
    ).select(
        *SERIES,
        "date",
        "value",
        "points",
        F.when(known, low).otherwise(0.0).alias("lower_fence"),
        F.when(known, high).alias("upper_fence"),
        F.when(known, (F.col("value") < low) | (F.col("value") > high)).otherwise(False).alias("is_anomaly"),
    )


def _deviation(value: str = "value", mean: str = "mean") -> Column:
    return F.abs(ratio(F.col(value) - F.col(mean), F.col(mean)) * 100)


def _beyond_critical() -> Column:
    """abs(z) > 3, with the infinite score of a flat baseline counted in."""
    return F.col("is_anomaly") & (F.col("z").isNull() | (F.abs("z") > CRITICAL_SIGMA))


def _alert_id(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("date").cast("string"))


def _one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", rounded(value, 1))


def revenue_zscore(mart: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """Revenue of every day: CRITICAL beyond 3 deviations, WARNING beyond 2, else INFO."""
    scored = score_zscore(metric(mart, "ecommerce", "revenue", "total_revenue"), SIGMA, lookback)
    hit = F.col("is_anomaly")
    way = F.when(F.col("value") > F.col("mean"), "↑ up").otherwise("↓ down")
    text = F.concat(
        F.lit("Revenue "), way, F.lit(" "), _one_decimal(_deviation()),
        F.lit("%. Check for system issues or special events."),
    )
    return scored.select(
        _alert_id("ecom_revenue_").alias("alert_id"),
        F.when(_beyond_critical(), "CRITICAL").when(hit, "WARNING").otherwise("INFO").alias("severity"),
        "domain",
        "metric",
        "date",
        F.col("value").alias("current_value"),
        rounded(F.col("mean"), 4).alias("expected_value"),
        F.when(hit, rounded(F.col("mean") - 2 * F.col("sd"), 4)).alias("expected_range_min"),
        F.when(hit, rounded(F.col("mean") + 2 * F.col("sd"), 4)).alias("expected_range_max"),
        F.when(hit, rounded(F.col("z"), 6)).alias("z_score"),
        F.when(hit, rounded(_deviation(), 4)).otherwise(0.0).alias("deviation_pct"),
        F.when(hit, F.coalesce(text, F.lit("Revenue changed from zero. Check for system issues or special events.")))
        .otherwise("No anomaly detected")
        .alias("recommendation"),
        "is_anomaly",
    )


def _simple_alert(scored: DataFrame, prefix: str, severity: str, advice: str) -> DataFrame:
    return scored.select(
        _alert_id(prefix).alias("alert_id"),
        F.lit(severity).alias("severity"),
        "domain",
        "metric",
        "date",
        F.col("value").alias("current_value"),
        rounded(F.col("mean"), 4).alias("expected_value"),
        rounded(F.col("z"), 6).alias("z_score"),
        rounded(_deviation(), 4).alias("deviation_pct"),
        F.lit(advice).alias("recommendation"),
    )


def conversion_zscore(mart: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """Days whose conversion rate is off by more than 2 deviations; always a WARNING."""
    scored = score_zscore(metric(mart, "ecommerce", "conversion_rate", "conversion_rate"), SIGMA, lookback)
    return _simple_alert(scored.filter("is_anomaly"), "ecom_conv_", "WARNING", CONVERSION_ADVICE)


def on_time_low(mart: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """Days whose on-time share lies more than 1.5 deviations *below* the mean; CRITICAL."""
    series = metric(mart, "supply_chain", "on_time_delivery_pct", "on_time_delivery_pct")
    scored = score_zscore(series, DELIVERY_SIGMA, lookback)
    return _simple_alert(scored.filter("is_anomaly and value < mean"), "sc_delivery_", "CRITICAL", DELIVERY_ADVICE)


def budget_variance(fact: DataFrame) -> DataFrame:
    """Account months off plan by more than 10 percent (CRITICAL beyond 20)."""
    size = F.abs("variance_pct")
    return fact.filter(size > BUDGET_WARNING_PCT).select(
        F.concat(F.lit("fin_budget_"), F.col("gl_account_id"), F.lit("_"), F.col("date").cast("string")).alias("alert_id"),
        F.when(size > BUDGET_CRITICAL_PCT, "CRITICAL").otherwise("WARNING").alias("severity"),
        F.lit("financial").alias("domain"),
        F.lit("budget_variance").alias("metric"),
        "gl_account_id",
        "date",
        "variance_pct",
        double("variance_amount").alias("variance_amount"),
        F.concat(
            F.lit("Investigate budget variance of "), _one_decimal(F.col("variance_pct")),
            F.lit("%. Review actual spending patterns."),
        ).alias("recommendation"),
    )


def orders_count(mart: DataFrame, method: str = "zscore", lookback: int = LOOKBACK) -> DataFrame:
    """Order count of every day by z-score (INFO, WARNING, CRITICAL) or by fences (INFO, WARNING)."""
    checks.one_of("method", method, checks.DETECTION_METHODS)
    series = metric(mart, "ecommerce", "orders", "total_orders")
    alert = [_alert_id("ecom_orders_").alias("alert_id"), F.lit(method).alias("method"), F.col("date")]
    if method == "iqr":
        return score_iqr(series, FENCE, lookback).select(
            *alert,
            "is_anomaly",
            F.col("value").alias("current_value"),
            rounded(F.col("lower_fence"), 6).alias("lower_fence"),
            rounded(F.col("upper_fence"), 6).alias("upper_fence"),
            F.when(F.col("is_anomaly"), "WARNING").otherwise("INFO").alias("severity"),
        )
    return score_zscore(series, SIGMA, lookback).select(
        *alert,
        "is_anomaly",
        F.col("value").alias("current_value"),
        rounded(F.col("mean"), 4).alias("mean"),
        rounded(F.col("z"), 6).alias("z_score"),
        F.when(_beyond_critical(), "CRITICAL")
        .when(F.col("is_anomaly"), "WARNING")
        .otherwise("INFO")
        .alias("severity"),
    )


def alerts(
    ecommerce: DataFrame,
    supply_chain: DataFrame,
    budget_actuals: DataFrame,
    severity: str | None = None,
    domain: str | None = None,
    lookback: int = LOOKBACK,
) -> DataFrame:
    """Every alert of every detector (not INFO), optionally of one severity or domain.

    The shop mart is unpivoted and scored once for its three metrics.
    """
    shop = {"revenue": "total_revenue", "conversion_rate": "conversion_rate", "orders": "total_orders"}
    series = metrics(ecommerce, "ecommerce", shop).unionByName(
        metrics(supply_chain, "supply_chain", {"on_time_delivery_pct": "on_time_delivery_pct"})
    )
    is_metric = {name: F.col("metric") == name for name in (*shop, "on_time_delivery_pct")}
    late = is_metric["on_time_delivery_pct"]
    sigma = F.when(late, DELIVERY_SIGMA).otherwise(SIGMA)
    prefix = (
        F.when(late, "sc_delivery_")
        .when(is_metric["revenue"], "ecom_revenue_")
        .when(is_metric["conversion_rate"], "ecom_conv_")
        .otherwise("ecom_orders_")
    )
    ladder = F.when(_beyond_critical(), "CRITICAL").otherwise("WARNING")
    scored = (
        score_zscore(series, sigma, lookback)
        .filter(F.col("is_anomaly") & (~late | (F.col("value") < F.col("mean"))))
        .select(
            F.concat(prefix, F.col("date").cast("string")).alias("alert_id"),
            F.when(late, "CRITICAL").when(is_metric["conversion_rate"], "WARNING").otherwise(ladder).alias("severity"),
            "domain",
            "metric",
            "date",
            F.col("value").alias("current_value"),
            rounded(F.col("mean"), 4).alias("expected_value"),
            rounded(_deviation(), 4).alias("deviation_pct"),
        )
    )
    budget = budget_variance(budget_actuals).select(
        "alert_id",
        "severity",
        "domain",
        "metric",
        "date",
        F.col("variance_pct").alias("current_value"),
        F.lit(0.0).alias("expected_value"),
        F.abs("variance_pct").alias("deviation_pct"),
    )
    found = scored.unionByName(budget)
    if severity is not None:
        found = found.filter(F.col("severity") == severity)
    if domain is not None:
        found = found.filter(F.col("domain") == domain)
    return found


def unacknowledged(found: DataFrame, acknowledgements: DataFrame) -> DataFrame:
    """Alerts that no row of the acknowledgement table names."""
    return found.join(acknowledgements.select("alert_id"), "alert_id", "left_anti")


def acknowledge(alerts_to_close: DataFrame) -> DataFrame:
    """Rows to append to the acknowledgement table."""
    return alerts_to_close.select("alert_id", F.lit("acknowledged").alias("status"))


def scored_metrics(series: DataFrame, method: str = "zscore", lookback: int = LOOKBACK) -> DataFrame:
    """Verdict on every row of any metric frame, with the limits it was held against."""
    checks.one_of("method", method, checks.DETECTION_METHODS)
    if method == "iqr":
        return score_iqr(series, FENCE, lookback).select(
            *SERIES,
            "date",
            F.col("value").alias("current_value"),
            rounded(F.col("lower_fence"), 6).alias("lower_fence"),
            rounded(F.col("upper_fence"), 6).alias("upper_fence"),
            "is_anomaly",
        )
    return score_zscore(series, SIGMA, lookback).select(
        *SERIES,
        "date",
        F.col("value").alias("current_value"),
        rounded(F.col("mean"), 4).alias("expected_value"),
        rounded(F.col("z"), 6).alias("z_score"),
        "is_anomaly",
    )


def all_metrics(ecommerce: DataFrame, supply_chain: DataFrame, financial: DataFrame) -> DataFrame:
    """The metric frame of the three marts."""
    return (
        metrics(
            ecommerce,
            "ecommerce",
            {"revenue": "total_revenue", "orders": "total_orders", "conversion_rate": "conversion_rate"},
        )
        .unionByName(
            metrics(
                supply_chain,
                "supply_chain",
                {"on_time_delivery_pct": "on_time_delivery_pct", "lead_time_days": "average_lead_time_days"},
            )
        )
        .unionByName(metrics(financial, "financial", {"net_income": "net_income", "expense": "total_expense"}))
    )


def summary(verdicts: DataFrame) -> DataFrame:
    """Days judged and anomalies found per metric, with the last anomalous day."""
    hit = F.col("is_anomaly")
    return verdicts.groupBy("domain", "metric").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum(hit.cast("bigint")).alias("anomalies"),
        rounded(F.sum(hit.cast("bigint")) * 100.0 / F.count(F.lit(1)), 2).alias("anomaly_pct"),
        F.max(F.when(hit, F.col("date"))).alias("last_anomaly"),
    )


def seasonal(mart: DataFrame, trend_rows: int = 28, lookback: int = LOOKBACK) -> DataFrame:
    """Revenue anomalies after trend and weekday pattern are taken out.

    Trend is the mean of the ``trend_rows`` rows before the day; the weekday effect is the mean
    distance from trend of that weekday over the whole mart; the residual is then z-scored.
    """
    days = mart.filter("total_orders > 0").select("date", F.col("total_revenue").alias("value"))
    before = Window.orderBy("date").rowsBetween(-trend_rows, -1)
    weekday = Window.partitionBy(F.weekday("date"))
    # Sums are exact (decimal), so means do not depend on the order of the rows.
    trend = ratio(F.sum(F.col("value").cast("decimal(20,2)")).over(before), F.count("value").over(before))
    effect = ratio(F.sum(F.col("distance").cast("decimal(20,6)")).over(weekday), F.count("distance").over(weekday))
    residual = (
        days.withColumn("distance", F.col("value") - trend)
        .filter("distance is not null")
        .withColumn("residual", rounded(F.col("distance") - effect, 2))
    )
    scored = score_zscore(metric(residual, "ecommerce", "revenue_residual", "residual"), SIGMA, lookback)
    return scored.select(
        "date",
        F.col("value").alias("residual"),
        rounded(F.col("mean"), 4).alias("expected_residual"),
        rounded(F.col("z"), 6).alias("z_score"),
        "is_anomaly",
    )
