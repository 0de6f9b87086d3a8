"""Forecasts for all entities in one job.

Histories are daily sums, so an entity has at most one row per calendar day before its last
rows are picked; ``row_number() <= n`` lets Spark drop the rest before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions import checks
from kpiloom.functions.expressions import or_zero, rounded, units

# History lengths, bounds and confidence.
HISTORY_DAYS = 90
MIN_DAYS = 14
DELIVERIES = 50
LOWER, UPPER = 0.8, 1.2
LEAD_TIME_CONFIDENCE = 0.85
GRID_STEP, GRID_REACH = 0.05, 19


def _floor_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def _clamp(value: Column) -> Column:
    return F.greatest(F.least(value, F.lit(1.0)), F.lit(0.0))


def last_days(daily: DataFrame, entity: str, rows: int = HISTORY_DAYS) -> DataFrame:
    """The newest ``rows`` days of each entity; ``age`` is 0 for the newest, then 1, 2, …"""
    newest = Window.partitionBy(entity).orderBy(F.desc("date"))
    return (
        daily.withColumn("rank", F.row_number().over(newest))
        .filter(F.col("rank") <= rows)
        .withColumn("age", F.col("rank") - 1)
        .drop("rank")
    )


def line_fit(history: DataFrame, entity: str, value: str) -> DataFrame:
    """Least-squares line over the day index. The fit is against ``-age``, so the newest day is
    at 0 and day ``h`` of the forecast at ``h``; slope and R² do not depend on the origin."""
    x = -F.col("age")
    y = F.col(value).cast("double")
    return (
        history.groupBy(entity)
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("level"),
            F.regr_r2(y, x).alias("r2"),
        )
        .filter(F.col("points") >= MIN_DAYS)
    )


def _ahead(horizon_days: int) -> Column:
    checks.horizon(horizon_days)
    return F.explode(F.sequence(F.lit(1), F.lit(horizon_days))).alias("day")


def demand_product(product_sales: DataFrame, horizon_days: int = 30) -> DataFrame:
    """Daily quantity of each product for the next days, from a line through its last 90 sale
    days (at least 14), never below 0, with bounds 20 percent around it."""
    fits = line_fit(last_days(product_sales.select("product_id", "date", "quantity"), "product_id"), "product_id", "quantity")
    value = _floor_zero(F.col("level") + F.col("slope") * F.col("day"))
    return (
        fits.select("product_id", "slope", "level", "r2", _ahead(horizon_days))
        .withColumn("value", value)
        .select(
            "product_id",
            "day",
            rounded(F.col("value"), 6).alias("forecasted_quantity"),
            rounded(F.col("value") * LOWER, 6).alias("lower_bound"),
            rounded(F.col("value") * UPPER, 6).alias("upper_bound"),
            # A flat history is fitted exactly; its R² is undefined in SQL and 1 by convention.
            rounded(_clamp(F.coalesce("r2", F.lit(1.0))), 6).alias("confidence_level"),
        )
    )


def category_sales(product_sales: DataFrame, products: DataFrame) -> DataFrame:
    return (
        product_sales.join(products.select("product_id", "category"), "product_id")
        .groupBy("category", "date")
        .agg(F.sum("quantity").alias("quantity"))
    )


def demand_category_mean(daily: DataFrame, horizon_days: int = 30) -> DataFrame:
    """Mean daily quantity of each category over its last 90 sale days, repeated ahead."""
    return (
        last_days(daily, "category")
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("points"), F.avg("quantity").alias("mean"))
        .filter(F.col("points") >= MIN_DAYS)
        .select("category", "mean", _ahead(horizon_days))
        .select("category", "day", rounded(F.col("mean"), 6).alias("forecasted_quantity"))
    )


def demand_category_arima(daily: DataFrame, horizon_days: int = 30) -> DataFrame:
    """ARIMA(1,1,1) without constant, fitted by least conditional squares over a grid.

    A category is one row with an array of at most 89 daily differences. Each grid point is a
    row that folds that array, so the fit spreads over tasks whatever the number of categories.
    """
    history = (
        last_days(daily, "category")
        .groupBy("category")
        .agg(F.sort_array(F.collect_list(F.struct(-F.col("age"), F.col("quantity").cast("double").alias("y")))).alias("h"))
        .filter(F.size("h") >= MIN_DAYS)
        .select("category", F.transform("h", lambda s: s["y"]).alias("y"))
        .select(
            "category",
            F.element_at("y", -1).alias("last"),
            F.transform(F.sequence(F.lit(2), F.size("y")), lambda i: F.element_at("y", i) - F.element_at("y", i - 1)).alias("d"),
        )
    )
    steps = F.sequence(F.lit(-GRID_REACH), F.lit(GRID_REACH))
    grid = (
        history.select("*", F.explode(steps).alias("phi_step"))
        .repartition("category", "phi_step")
        .select("*", F.explode(steps).alias("theta_step"))
        .withColumn("phi", F.col("phi_step") * GRID_STEP)
        .withColumn("theta", F.col("theta_step") * GRID_STEP)
    )

    def step(state: Column, x: Column) -> Column:
        error = x - F.col("phi") * state["p"] - F.col("theta") * state["e"]
        return F.struct(x.alias("p"), error.alias("e"), (state["s"] + error * error).alias("s"))

    start = F.struct(F.element_at("d", 1).alias("p"), F.lit(0.0).alias("e"), F.lit(0.0).alias("s"))
    fits = grid.withColumn("end", F.aggregate(F.slice("d", 2, F.size("d")), start, step)).groupBy("category").agg(
        F.min(
            F.struct(
                F.col("end.s").alias("css"),
                "phi_step",
                "theta_step",
                "phi",
                "theta",
                F.col("end.p").alias("p"),
                F.col("end.e").alias("e"),
                "last",
            )
        ).alias("best")
    )
    phi = F.col("phi")
    first = phi * F.col("p") + F.col("theta") * F.col("e")
    return (
        fits.select("category", "best.*", _ahead(horizon_days))
        .withColumn("value", F.col("last") + first * (1 - F.pow(phi, F.col("day"))) / (1 - phi))
        .select(
            "category",
            "day",
            rounded(phi, 2).alias("phi"),
            rounded(F.col("theta"), 2).alias("theta"),
            rounded(_floor_zero(F.col("value")), 4).alias("forecasted_quantity"),
        )
    )


def lead_time(deliveries: DataFrame) -> DataFrame:
    """Expected lead time of each supplier: mean and one population deviation of its last 50
    deliveries, rounded half to even."""
    newest = Window.partitionBy("supplier_id").orderBy(
        F.desc("delivery_date"), F.desc("delivery_id"), F.desc("product_id"), F.desc("lead_time_days")
    )
    last = (
        deliveries.select("supplier_id", "delivery_date", "delivery_id", "product_id", "lead_time_days")
        .withColumn("rank", F.row_number().over(newest))
        .filter(F.col("rank") <= DELIVERIES)
    )
    mean, sd = F.avg("lead_time_days"), F.stddev_pop("lead_time_days")

    def whole(value: Column) -> Column:
        return F.bround(rounded(value, 9)).cast("int")

    return last.groupBy("supplier_id").agg(
        whole(mean).alias("forecasted_lead_time_days"),
        whole(mean - sd).alias("lower_bound"),
        whole(mean + sd).alias("upper_bound"),
        F.lit(LEAD_TIME_CONFIDENCE).alias("confidence_level"),
        F.count(F.lit(1)).alias("based_on_deliveries"),
    )


def cash_flow_days(order_totals: DataFrame, transactions: DataFrame) -> DataFrame:
    """Money in (orders not cancelled) and out (credits of payments) per day, 0 where a side
    has none."""
    inflow = (
        order_totals.filter(F.col("order_status") != "cancelled").groupBy("date").agg(units(F.sum("total_cents")).alias("inflow"))
    )
    outflow = (
        transactions.filter(F.col("transaction_type").isin("payment", "expense"))
        .groupBy("date")
        .agg(F.sum("credit_amount").cast("double").alias("outflow"))
    )
    return inflow.join(outflow, "date", "full").select(
        "date",
        or_zero("inflow").alias("inflow"),
        or_zero("outflow").alias("outflow"),
        rounded(or_zero("inflow") - or_zero("outflow"), 2).alias("net_flow"),
    )


def cash_flow(daily: DataFrame, horizon_days: int = 30) -> DataFrame:
    """Money in and out for the next days: a line through each of the last 90 days' sums."""
    x = -F.col("age")
    fits = (
        last_days(daily.withColumn("ledger", F.lit(1)), "ledger")
        .groupBy("ledger")
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.regr_slope("inflow", x).alias("in_slope"),
            F.regr_intercept("inflow", x).alias("in_level"),
            F.regr_slope("outflow", x).alias("out_slope"),
            F.regr_intercept("outflow", x).alias("out_level"),
            ((F.coalesce(F.regr_r2("inflow", x), F.lit(1.0)) + F.coalesce(F.regr_r2("outflow", x), F.lit(1.0))) / 2).alias("fit"),
        )
        .filter(F.col("points") >= MIN_DAYS)
    )
    inflow = _floor_zero(F.col("in_level") + F.col("in_slope") * F.col("day"))
    outflow = _floor_zero(F.col("out_level") + F.col("out_slope") * F.col("day"))
    return fits.select("*", _ahead(horizon_days)).select(
        "day",
        rounded(inflow, 2).alias("forecasted_inflow"),
        rounded(outflow, 2).alias("forecasted_outflow"),
        rounded(inflow - outflow, 2).alias("net_flow"),
        rounded(_clamp(F.col("fit")), 6).alias("confidence_level"),
    )


def demand_trend(product_sales: DataFrame) -> DataFrame:
    """Slope of each product's demand line and its direction: up or down beyond 0.01 units a
    day, else stable."""
    history = last_days(product_sales.select("product_id", "date", "quantity"), "product_id")
    slope = rounded(F.col("slope"), 6)
    return line_fit(history, "product_id", "quantity").select(
        "product_id",
        "points",
        slope.alias("slope_per_day"),
        F.when(slope > 0.01, "up").when(slope < -0.01, "down").otherwise("stable").alias("trend_direction"),
    )


def reorder(product_sales: DataFrame, products: DataFrame) -> DataFrame:
    """Demand over each product's lead time against its stock, and the quantity to reorder.

    The daily forecasts are summed from an array of the lead time's length, without one row
    per day.
    """
    history = last_days(product_sales.select("product_id", "date", "quantity"), "product_id")
    stock = products.select("product_id", "current_stock_level", "reorder_point", "lead_time_days")
    days = F.sequence(F.lit(1), F.col("lead_time_days"))
    demand = F.aggregate(
        days, F.lit(0.0), lambda total, day: total + _floor_zero(F.col("level") + F.col("slope") * day)
    )
    return (
        line_fit(history, "product_id", "quantity")
        .join(stock, "product_id")
        .withColumn("demand", rounded(demand, 4))
        .select(
            "product_id",
            "current_stock_level",
            "lead_time_days",
            F.col("demand").alias("lead_time_demand"),
            (F.col("current_stock_level") - F.col("demand") < F.col("reorder_point")).alias("needs_reorder"),
            F.ceil(_floor_zero(F.col("reorder_point") + F.col("demand") - F.col("current_stock_level")))
            .cast("bigint")
            .alias("reorder_quantity"),
        )
    )


def accuracy(daily: DataFrame, entity: str, value: str, hold_out: int = 14) -> DataFrame:
    """Mean absolute percentage error of the line and of the mean, per entity.

    The newest ``hold_out`` days are forecast from the 90 days before them (at least 14).
    """
    rows = last_days(daily.select(entity, "date", F.col(value).cast("double").alias("y")), entity, HISTORY_DAYS + hold_out)
    # The newest training day has age ``hold_out``; it is moved to 0, test days are 1, 2, …
    ahead = hold_out - F.col("age")
    training, x = F.col("age") >= hold_out, F.when(F.col("age") >= hold_out, ahead)
    y = F.when(training, F.col("y"))
    fits = rows.groupBy(entity).agg(
        F.count(y).alias("points"),
        F.avg(y).alias("mean"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("level"),
        F.filter(F.collect_list(F.struct(ahead.alias("day"), F.col("y"))), lambda r: (r["day"] > 0) & (r["y"] != 0)).alias("tests"),
    )
    line = lambda day: _floor_zero(F.col("level") + F.col("slope") * day)
    flat = lambda day: F.col("mean")

    def mape(predict) -> Column:
        total = F.aggregate(
            F.sort_array("tests"), F.lit(0.0), lambda a, r: a + F.abs(r["y"] - predict(r["day"])) / F.abs(r["y"])
        )
        return total * 100 / F.nullif(F.size("tests"), F.lit(0))

    return (
        fits.filter(F.col("points") >= MIN_DAYS)
        .select(entity, F.size("tests").alias("tested_days"), mape(line).alias("line"), mape(flat).alias("mean"))
        .selectExpr(entity, "tested_days", "stack(2, 'linear', line, 'mean', mean) as (model, mape)")
        .select(entity, "model", "tested_days", rounded(F.col("mape"), 4).alias("mape"))
    )
