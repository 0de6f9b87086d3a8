"""ARIMA by likelihood against a Kalman filter in matrices and a direct search."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.operators import arima

DAY = datetime.date(2024, 1, 1)


def sales(spark, series):
    rows = [(c, DAY + datetime.timedelta(days=2 * i), int(y)) for c, ys in series.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "category string, date date, quantity bigint")


def kalman(d, phi, theta):
    """Log likelihood at the best variance, and per day the expected value and its variance, by the
    textbook recursion over the two-dimensional state."""
    T, R, Z = np.array([[phi, 1.0], [0, 0]]), np.array([[1.0], [theta]]), np.array([[1.0, 0]])
    a = np.zeros((2, 1))
    P = np.linalg.solve(np.eye(4) - np.kron(T, T), (R @ R.T).reshape(-1)).reshape(2, 2)
    total, logs, days = 0.0, 0.0, []
    for y in d:
        v, f = y - (Z @ a)[0, 0], (Z @ P @ Z.T)[0, 0]
        days.append(((Z @ a)[0, 0], f))
        total, logs = total + v * v / f, logs + math.log(f)
        gain = P @ Z.T / f
        a, P = T @ (a + gain * v), T @ (P - gain @ Z @ P) @ T.T + R @ R.T
    n = len(d)
    return -n / 2 * (math.log(2 * math.pi) + 1 + math.log(total / n)) - logs / 2, days, total / n, (Z @ a)[0, 0]


def made(seed, phi, theta, n=80):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 20, n + 1)
    d = np.zeros(n + 1)
    for t in range(1, n + 1):
        d[t] = phi * d[t - 1] + e[t] + theta * e[t - 1]
    return np.rint(2000 + np.cumsum(d[1:])).astype(int).tolist()


SERIES = {"a": made(1, 0.6, -0.3), "b": made(2, -0.4, 0.5, 30), "c": made(3, 0.85, 0.2), "d": made(4, 0.0, -0.95), "short": [1] * 13}


@pytest.fixture(scope="module")
def fitted(spark):
    return {r["category"]: r for r in arima.demand(sales(spark, SERIES), horizon_days=5).filter("day = 5").collect()}


def test_likelihood_equals_the_matrix_filter(fitted):
    assert sorted(fitted) == ["a", "b", "c", "d"]
    for name, row in fitted.items():
        d = np.diff(SERIES[name])
        assert row["log_likelihood"] == pytest.approx(kalman(d, row["phi"], row["theta"])[0], abs=2e-6)


def test_no_point_of_a_fine_grid_is_likelier(fitted):
    for name, row in fitted.items():
        d = np.diff(SERIES[name])
        around = [(row["phi"] + i * 0.004, row["theta"] + j * 0.004) for i in range(-5, 6) for j in range(-5, 6)]
        best = max(kalman(d, p, t)[0] for p, t in around if abs(p) <= 0.98 and abs(t) <= 0.98)
        whole = max(kalman(d, i / 10, j / 10)[0] for i in range(-9, 10) for j in range(-9, 10))
        assert row["log_likelihood"] >= max(best, whole) - 2e-4


def test_forecast_goes_on_from_the_filter(fitted):
    for name, row in fitted.items():
        d = np.diff(SERIES[name])
        step, level = kalman(d, row["phi"], row["theta"])[3], float(SERIES[name][-1])
        for _ in range(5):
            level, step = level + step, step * row["phi"]
        assert row["forecasted_quantity"] == pytest.approx(max(level, 0), abs=2e-3)


def test_residuals_are_those_of_the_filter(spark, fitted):
    jump = SERIES["a"][:50] + [y + 400 for y in SERIES["a"][50:]]
    series = {**SERIES, "jump": jump, "flat": [7] * 20}
    rows = arima.residuals(sales(spark, series)).collect()
    by = {name: sorted((r for r in rows if r["category"] == name), key=lambda r: r["date"]) for name in series}
    assert {name: len(found) for name, found in by.items()} == {name: len(ys) - 1 if name != "short" else 0 for name, ys in series.items()}
    for name in fitted:
        d = np.diff(series[name])
        _, days, variance, _ = kalman(d, fitted[name]["phi"], fitted[name]["theta"])
        for i, (r, (a, f)) in enumerate(zip(by[name], days)):
            assert r["date"] == DAY + datetime.timedelta(days=2 * (i + 1)) and r["value"] == series[name][i + 1]
            assert r["expected_value"] == pytest.approx(series[name][i] + a, abs=1e-3)
            assert r["z_score"] == pytest.approx((d[i] - a) / math.sqrt(variance * f), abs=1e-4)
            assert r["is_anomaly"] == (abs(r["z_score"]) > 2)
    worst = max(by["jump"], key=lambda r: abs(r["z_score"]))
    assert worst["value"] == jump[50] and worst["z_score"] > 5 and worst["is_anomaly"]
    assert not any(r["is_anomaly"] or r["z_score"] for r in by["flat"])


def test_only_the_last_ninety_days_count(spark):
    long = made(9, 0.3, 0.2, 200)
    rows = arima.residuals(sales(spark, {"a": long}))
    assert rows.count() == 89
    assert rows.agg(F.min("date")).first()[0] == DAY + datetime.timedelta(days=2 * 111)
    assert arima.residuals(sales(spark, {})).count() == 0
