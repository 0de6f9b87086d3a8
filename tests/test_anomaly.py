"""Detection kernels on small vectors, and against a plain Python count."""

import datetime
import math
import random
import statistics

import pytest

from kpiloom.operators import anomaly

DAY = datetime.date(2024, 1, 1)


def series(spark, values, metric="m", entity=""):
    rows = [("d", metric, entity, DAY + datetime.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "domain string, metric string, entity string, date date, value double")


def last(df):
    return max(df.collect(), key=lambda r: r["date"])


@pytest.mark.parametrize(
    "history, current, sigma, anomalous",
    [
        ([100, 102, 98, 101, 99, 100.5, 100], 100, 2.0, False),
        ([100] * 10, 200, 1.0, True),
        ([100] * 10, 100, 2.0, False),
        ([3.33] * 29, 3.33, 2.0, False),
        ([10, 20], 15, 2.0, False),
        ([100, 101, 99, 100, 102, 98, 100, 101, 99, 100], 150, 2.0, True),
        ([90, 95, 100, 105, 110, 98, 102, 97, 103, 99], 100, 2.0, False),
    ],
)
def test_zscore(spark, history, current, sigma, anomalous):
    verdict = last(anomaly.score_zscore(series(spark, [*history, current]), sigma))
    assert verdict["is_anomaly"] is anomalous
    if len(history) < 3:
        assert (verdict["mean"], verdict["sd"], verdict["z"]) == (0.0, 0.0, 0.0)
    elif len(set(history)) == 1:
        assert verdict["mean"] == history[0] and verdict["sd"] == 0.0
        assert verdict["z"] is None if anomalous else verdict["z"] == 0.0
    else:
        sd = statistics.pstdev(history)
        assert math.isclose(verdict["z"], (current - statistics.fmean(history)) / sd)


def test_zscore_limit_is_strict(spark):
    history = [98.0, 102.0, 98.0, 102.0]  # mean 100, population deviation 2
    assert last(anomaly.score_zscore(series(spark, [*history, 104.0]), 2.0))["is_anomaly"] is False
    assert last(anomaly.score_zscore(series(spark, [*history, 104.01]), 2.0))["is_anomaly"] is True


@pytest.mark.parametrize(
    "history, current, anomalous",
    [
        (range(20, 80), -50, True),
        (range(10, 50), 30, False),
        ([1, 2, 3], 2, False),
        ([10, 11, 10, 12, 11, 10, 13, 11, 10, 12], 50, True),
        ([10, 11, 10, 12, 11, 10, 13, 11, 10, 12], 11, False),
    ],
)
def test_iqr(spark, history, current, anomalous):
    verdict = last(anomaly.score_iqr(series(spark, [*history, current]), lookback=60))
    assert verdict["is_anomaly"] is anomalous
    if len(list(history)) < 4:
        assert verdict["lower_fence"] == 0.0 and verdict["upper_fence"] is None


def test_iqr_fences(spark):
    verdict = last(anomaly.score_iqr(series(spark, [*range(20, 80), 0]), lookback=60))
    assert (verdict["lower_fence"], verdict["upper_fence"]) == (-9.5, 108.5)


def test_baseline_is_rows_before_not_days(spark):
    """Gaps in the calendar do not shorten the baseline; the row itself is not part of it."""
    rng = random.Random(5)
    values = [rng.gauss(100, 5) for _ in range(80)]
    rows = [("d", "m", "", DAY + datetime.timedelta(days=3 * i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "domain string, metric string, entity string, date date, value double")
    got = sorted(anomaly.score_zscore(df).collect(), key=lambda r: r["date"])
    for i, row in enumerate(got):
        before = values[max(0, i - 30) : i]
        assert row["points"] == len(before)
        if len(before) >= 3:
            z = (values[i] - statistics.fmean(before)) / statistics.pstdev(before)
            assert math.isclose(row["z"], z, rel_tol=1e-9) and row["is_anomaly"] == (abs(z) > 2)


def test_entities_do_not_mix(spark):
    both = series(spark, [1.0] * 9 + [50.0], entity="a").unionByName(series(spark, [50.0] * 10, entity="b"))
    found = [(r["entity"], r["value"]) for r in anomaly.score_zscore(both).collect() if r["is_anomaly"]]
    assert found == [("a", 50.0)]


def shop(spark, revenue, orders=None):
    orders = orders or [1] * len(revenue)
    rows = [(DAY + datetime.timedelta(days=i), float(v), n, None) for i, (v, n) in enumerate(zip(revenue, orders))]
    return spark.createDataFrame(rows, "date date, total_revenue double, total_orders bigint, conversion_rate double")


def test_revenue_severity(spark):
    base = [98.0, 102.0] * 5
    severity = lambda v: last(anomaly.revenue_zscore(shop(spark, [*base, v])))["severity"]
    assert severity(100.0) == "INFO"
    assert severity(105.0) == "WARNING"
    assert severity(107.0) == "CRITICAL"


def test_revenue_text(spark):
    alert = last(anomaly.revenue_zscore(shop(spark, [*[98.0, 102.0] * 5, 50.0])))
    assert alert["recommendation"] == "Revenue ↓ down 50.0%. Check for system issues or special events."
    assert alert["alert_id"] == "ecom_revenue_2024-01-11" and alert["deviation_pct"] == 50.0
    assert (alert["expected_range_min"], alert["expected_range_max"]) == (96.0, 104.0)


def test_zero_mean_does_not_divide(spark):
    alert = last(anomaly.revenue_zscore(shop(spark, [0.0] * 5 + [9.0])))
    assert alert["severity"] == "CRITICAL" and alert["deviation_pct"] is None and alert["z_score"] is None


def test_only_low_on_time_alerts(spark):
    base = [90.0, 92.0] * 5
    rows = lambda v: spark.createDataFrame(
        [(DAY + datetime.timedelta(days=i), x) for i, x in enumerate([*base, v])], "date date, on_time_delivery_pct double"
    )
    assert [r["severity"] for r in anomaly.on_time_low(rows(80.0)).collect() if r["current_value"] == 80.0] == ["CRITICAL"]
    assert [r for r in anomaly.on_time_low(rows(99.0)).collect() if r["current_value"] == 99.0] == []


def test_budget_thresholds(spark):
    rows = [("a", DAY, pct, 1) for pct in (None, 10.0, -10.01, 20.0, 20.01, -35.0)]
    df = spark.createDataFrame(rows, "gl_account_id string, date date, variance_pct double, variance_amount int")
    got = {r["variance_pct"]: r["severity"] for r in anomaly.budget_variance(df).collect()}
    assert got == {-10.01: "WARNING", 20.0: "WARNING", 20.01: "CRITICAL", -35.0: "CRITICAL"}


def test_acknowledged_alerts_disappear(spark):
    alerts = spark.createDataFrame([("a", "x"), ("b", "y")], "alert_id string, domain string")
    acks = anomaly.acknowledge(alerts.filter("domain = 'x'"))
    assert [r["alert_id"] for r in anomaly.unacknowledged(alerts, acks).collect()] == ["b"]


def test_empty_mart(spark):
    empty = shop(spark, [1.0]).filter("false")
    assert anomaly.revenue_zscore(empty).count() == 0
    assert anomaly.orders_count(empty, "iqr").count() == 0


def test_bad_parameters(spark):
    with pytest.raises(ValueError):
        anomaly.orders_count(shop(spark, [1.0]), "guess")
    with pytest.raises(ValueError):
        anomaly.score_zscore(series(spark, [1.0]), lookback=6)
