"""Forecasts against numpy on small histories."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.operators import forecast

DAY = datetime.date(2024, 1, 1)


def sales(spark, histories, entity="product_id", kind="bigint"):
    rows = [(key, DAY + datetime.timedelta(days=2 * i), q) for key, values in histories.items() for i, q in enumerate(values)]
    return spark.createDataFrame(rows, f"{entity} {kind}, date date, quantity bigint")


def test_demand_line(spark):
    rng = np.random.default_rng(3)
    histories = {1: rng.integers(1, 50, 120).tolist(), 2: rng.integers(1, 50, 20).tolist(), 3: [5] * 13}
    got = forecast.demand_product(sales(spark, histories), 5).collect()
    assert {r["product_id"] for r in got} == {1, 2}  # 13 days are too few
    for key in (1, 2):
        y = np.array(histories[key][-90:], dtype=float)
        slope, level = np.polyfit(np.arange(len(y)), y, 1)
        for row in (r for r in got if r["product_id"] == key):
            value = max(level + slope * (len(y) - 1 + row["day"]), 0)
            assert abs(row["forecasted_quantity"] - value) < 1e-5
            assert abs(row["lower_bound"] - 0.8 * value) < 1e-5 and abs(row["upper_bound"] - 1.2 * value) < 1e-5
        fit = 1 - ((y - level - slope * np.arange(len(y))) ** 2).sum() / ((y - y.mean()) ** 2).sum()
        assert abs(next(r for r in got if r["product_id"] == key)["confidence_level"] - fit) < 1e-5


def test_demand_never_falls_below_zero(spark):
    got = forecast.demand_product(sales(spark, {1: list(range(40, 0, -2))}), 30).collect()
    assert min(r["forecasted_quantity"] for r in got) == 0.0


def test_flat_history_is_certain(spark):
    row = forecast.demand_product(sales(spark, {1: [7] * 20}), 1).first()
    assert (row["forecasted_quantity"], row["confidence_level"]) == (7.0, 1.0)


def arima_by_numpy(y, horizon):
    d = np.diff(np.array(y, dtype=float))
    best = None
    for i in range(-19, 20):
        for j in range(-19, 20):
            phi, theta, e, s = i * 0.05, j * 0.05, 0.0, 0.0
            for t in range(1, len(d)):
                e = d[t] - phi * d[t - 1] - theta * e
                s += e * e
            if best is None or (s, i, j) < best[:3]:
                best = (s, i, j, phi, theta, e)
    _, _, _, phi, theta, e = best
    out, level, step = [], float(y[-1]), phi * d[-1] + theta * e
    for _ in range(horizon):
        level += step
        out.append(max(level, 0.0))
        step *= phi
    return phi, theta, out


def test_arima_grid(spark):
    rng = np.random.default_rng(11)
    noise = rng.normal(0, 10, 60)
    d = np.zeros(60)
    for t in range(1, 60):
        d[t] = 0.6 * d[t - 1] + noise[t] - 0.3 * noise[t - 1]
    y = np.maximum(np.rint(500 + np.cumsum(d)), 0).astype(int).tolist()
    got = sorted(
        forecast.demand_category_arima(sales(spark, {"a": y}, "category", "string"), 6).collect(), key=lambda r: r["day"]
    )
    phi, theta, values = arima_by_numpy(y, 6)
    assert abs(got[0]["phi"] - phi) < 1e-9 and abs(got[0]["theta"] - theta) < 1e-9
    assert np.allclose([r["forecasted_quantity"] for r in got], values, atol=1e-3)


def test_category_mean(spark):
    got = forecast.demand_category_mean(sales(spark, {"a": list(range(100)), "b": [1] * 5}, "category", "string"), 3).collect()
    assert {(r["category"], r["forecasted_quantity"]) for r in got} == {("a", 54.5)} and len(got) == 3


def deliveries(spark, leads):
    rows = [(1, DAY + datetime.timedelta(days=i), i, 1, lead) for i, lead in enumerate(leads)]
    return spark.createDataFrame(
        rows, "supplier_id bigint, delivery_date date, delivery_id bigint, product_id bigint, lead_time_days int"
    )


@pytest.mark.parametrize("leads", [[2, 3], [3, 4], [1] * 40 + [9] * 50, list(range(1, 80))])
def test_lead_time_rounds_half_to_even(spark, leads):
    last = leads[-50:]
    row = forecast.lead_time(deliveries(spark, leads)).first()
    mean, sd = np.mean(last), np.std(last)
    assert row["forecasted_lead_time_days"] == int(round(mean))
    assert (row["lower_bound"], row["upper_bound"]) == (int(round(mean - sd)), int(round(mean + sd)))
    assert row["based_on_deliveries"] == len(last) and row["confidence_level"] == 0.85


def test_cash_flow(spark):
    rows = [(DAY + datetime.timedelta(days=i), 1000.0 + 10 * i, 700.0) for i in range(20)]
    daily = spark.createDataFrame(rows, "date date, inflow double, outflow double")
    first = forecast.cash_flow(daily, 3).orderBy("day").first()
    assert (first["forecasted_inflow"], first["forecasted_outflow"], first["net_flow"]) == (1200.0, 700.0, 500.0)
    assert first["confidence_level"] == 1.0
    assert forecast.cash_flow(daily.limit(13), 3).count() == 0


def test_net_cash_flow(spark):
    totals = spark.createDataFrame(
        [(DAY, "shipped", 100_000), (DAY, "cancelled", 500)], "date date, order_status string, total_cents bigint"
    )
    ledger = spark.createDataFrame([(DAY, "payment", 700), (DAY, "invoice", 5)], "date date, transaction_type string, c int")
    ledger = ledger.withColumn("credit_amount", F.col("c").cast("decimal(15,2)"))
    row = forecast.cash_flow_days(totals, ledger).first()
    assert (row["inflow"], row["outflow"], row["net_flow"]) == (1000.0, 700.0, 300.0)


def test_accuracy_holds_out_the_newest_days(spark):
    y = [10 + i for i in range(60)]
    got = {r["model"]: r for r in forecast.accuracy(sales(spark, {"a": y}, "category", "string"), "category", "quantity").collect()}
    train, test = y[:46], y[46:]
    assert got["linear"]["mape"] == 0.0 and got["linear"]["tested_days"] == 14
    mean = sum(train) / len(train)
    assert abs(got["mean"]["mape"] - 100 * np.mean([abs(t - mean) / t for t in test])) < 1e-3


def test_horizon_limits(spark):
    for bad in (0, 366):
        with pytest.raises(ValueError):
            forecast.demand_product(sales(spark, {1: [1] * 20}), bad)
