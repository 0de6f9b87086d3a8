"""Daily KPI marts, one row per day, and two wider daily reports.

Every mart is built from sums that are reduced on the map side, so a day that holds most of
the rows costs one partial row per task. The marts themselves have one row per calendar day:
joins between them and running totals over them stay small at any data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.expressions import cents, date_id, double, flag, or_zero, percent, ratio, rounded, units

#: A customer sketch keeps 2^14 hashes (128 KB at most): it is exact up to so many customers, and beyond
#: that off by 0.8 % (one deviation). The error taken as its bound is four deviations.
SKETCH_LG_SIZE = 14
SKETCH_ERROR = 4 / 2 ** (SKETCH_LG_SIZE / 2)


def inventory_value(products: DataFrame) -> DataFrame:
    return products.agg(F.sum(F.col("current_stock_level") * F.col("cost")).alias("inventory_value"))


def funnel_daily(sessions: DataFrame) -> DataFrame:
    """Conversion = orders / sessions; abandonment = carts without an order / carts."""
    cart = F.col("has_cart") == 1
    return sessions.groupBy("date").agg(
        percent(F.sum("has_order"), F.count(F.lit(1))).alias("conversion_rate"),
        percent(F.sum(flag(cart & (F.col("has_order") == 0))), F.sum("has_cart")).alias("cart_abandonment_rate"),
    )


def ecommerce_daily(order_totals: DataFrame, sessions: DataFrame, products: DataFrame, sketches: bool = False) -> DataFrame:
    """Shop day. The distinct customer count goes through (day, customer) first, so a hot day
    is spread over its customers. Rates are null on days without click stream.

    With ``sketches`` a day also has ``customers_sketch``, which ``merged_customers`` merges to
    the distinct customers of any set of days.
    """
    by_customer = order_totals.groupBy("date", "customer_id").agg(
        *(F.sum(name).alias(name) for name in ("order_count", "total_cents", "cost_cents", "order_cents"))
    )
    sketch = [F.theta_sketch_agg("customer_id", SKETCH_LG_SIZE).alias("customers_sketch")] if sketches else []
    sales = by_customer.groupBy("date").agg(
        F.sum("order_count").alias("total_orders"),
        F.count("customer_id").alias("total_customers"),
        units(F.sum("total_cents")).alias("total_revenue"),
        units(F.sum("cost_cents")).alias("total_cost"),
        units(F.sum(F.col("order_cents") - F.col("cost_cents"))).alias("gross_profit"),
        *sketch,
    )
    stock = inventory_value(products).scalar()
    return sales.join(funnel_daily(sessions), "date", "full").select(
        date_id("date").alias("date_id"),
        "date",
        or_zero("total_orders").cast("bigint").alias("total_orders"),
        or_zero("total_customers").cast("bigint").alias("total_customers"),
        or_zero("total_revenue").alias("total_revenue"),
        or_zero("total_cost").alias("total_cost"),
        or_zero("gross_profit").alias("gross_profit"),
        or_zero(rounded(ratio(F.col("total_revenue"), F.col("total_orders")), 2)).alias("average_order_value"),
        "conversion_rate",
        "cart_abandonment_rate",
        or_zero(rounded(ratio(F.col("total_cost"), stock), 6)).alias("inventory_turnover"),
        *(["customers_sketch"] if sketches else []),
    )


def merged_customers(sketch: Column | str = "customers_sketch") -> Column:
    """An aggregate: the sketch of all customers of the days of a group."""
    return F.theta_union_agg(sketch, SKETCH_LG_SIZE)


def exact_customers(sketch: Column) -> Column:
    """The customers of a sketch that has kept them all. One that has left hashes out, and so gives more
    than 2^14, fails the read: its number would be an estimate."""
    customers = F.theta_sketch_estimate(sketch)
    refused = F.raise_error(F.lit("more customers than a sketch counts exactly: give the orders"))
    return F.when(customers > 2**SKETCH_LG_SIZE, refused).otherwise(customers)


def distinct_customers(mart: DataFrame, period: Column) -> DataFrame:
    """Customers of each period of a mart with sketches, and those who had bought in the period
    before it too: ``period``, ``customers``, ``returning``. Orders are not read again.

    Periods are few rows of one sketch each, put in order by date.
    """
    merged = mart.groupBy(period.alias("period")).agg(merged_customers().alias("sketch"))
    before = F.lag("sketch").over(Window.orderBy("period"))
    both = F.when(before.isNotNull(), F.theta_sketch_estimate(F.theta_intersection("sketch", before)))
    return merged.filter("period is not null").select(
        "period", F.theta_sketch_estimate("sketch").alias("customers"), F.coalesce(both, F.lit(0)).cast("bigint").alias("returning")
    )


def distinct_customers_check(order_totals: DataFrame, mart: DataFrame, period: Column) -> DataFrame:
    """Exact counts beside those of the sketches: whether customers are within the bound, and whether
    returning customers are within the bound of the two periods' customers together."""
    exact = order_totals.filter(F.col("customer_id").isNotNull()).select(period.alias("period"), "customer_id").distinct()
    at = exact.select("period").distinct().select("period", F.lag("period").over(Window.orderBy("period")).alias("period_before"))
    known = exact.select(F.col("period").alias("period_before"), "customer_id", F.lit(1).alias("known"))
    counted = exact.join(at, "period").join(known, ["period_before", "customer_id"], "left").groupBy("period")
    counted = counted.agg(F.count(F.lit(1)).alias("customers"), F.count("known").alias("returning"))
    sketched = distinct_customers(mart, period).select("period", F.col("customers").alias("c"), F.col("returning").alias("r"))
    before = F.coalesce(F.lag("customers").over(Window.orderBy("period")), F.lit(0))
    return counted.join(sketched, "period", "left").select(
        F.col("period").alias("date"),
        "customers",
        "returning",
        (F.abs(F.col("c") - F.col("customers")) <= SKETCH_ERROR * F.col("customers")).alias("customers_within_bound"),
        (F.abs(F.col("r") - F.col("returning")) <= SKETCH_ERROR * (F.col("customers") + before)).alias("returning_within_bound"),
    )


def supply_chain_daily(deliveries: DataFrame) -> DataFrame:
    on_time = F.sum(flag(F.col("is_on_time"))).cast("bigint")
    return (
        deliveries.groupBy(F.col("delivery_date").alias("date"))
        .agg(
            F.count("delivery_id").alias("total_deliveries"),
            on_time.alias("on_time_deliveries"),
            percent(on_time, F.count("is_on_time")).alias("on_time_delivery_pct"),
            units(F.sum(cents("total_cost"))).alias("total_procurement_cost"),
            rounded(F.avg("lead_time_days"), 2).alias("average_lead_time_days"),
            percent(F.sum(flag(F.col("is_quality_pass"))), F.count("is_quality_pass")).alias("supplier_quality_score"),
        )
        .select(date_id("date").alias("date_id"), "*")
    )


def financial_daily(transactions: DataFrame, budget_actuals: DataFrame, order_totals: DataFrame) -> DataFrame:
    """Ledger day. Revenue is all debits and expense all credits, as booked. The cash position
    is the running net of the ledger; the gross margin is that of the day's orders."""
    ledger = transactions.groupBy("date").agg(
        F.sum("debit_amount").alias("revenue"), F.sum("credit_amount").alias("expense")
    )
    budget = budget_actuals.groupBy("date").agg(F.sum("variance_amount").alias("variance"))
    margin = order_totals.groupBy("date").agg(
        percent(F.sum(F.col("order_cents") - F.col("cost_cents")), F.sum("order_cents")).alias("gross_margin_pct")
    )
    net = or_zero("revenue") - or_zero("expense")
    # One row per day: the running total is over the calendar, not over the ledger.
    to_date = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ledger.join(budget, "date", "full")
        .join(margin, "date", "full")
        .select(
            date_id("date").alias("date_id"),
            "date",
            double(or_zero("revenue")).alias("total_revenue"),
            double(or_zero("expense")).alias("total_expense"),
            double(net).alias("net_income"),
            double(or_zero("variance")).alias("budget_variance"),
            double(F.sum(net).over(to_date)).alias("cash_position"),
            "gross_margin_pct",
            percent(net, F.col("revenue")).alias("operating_margin_pct"),
        )
    )


def unified_daily(
    order_totals: DataFrame, deliveries: DataFrame, suppliers: DataFrame, products: DataFrame
) -> DataFrame:
    """Cross-domain day: shop revenue per active supplier, profit per product, stock to sales,
    and the mean lead time of what was ordered that day."""
    sales = order_totals.groupBy("date").agg(
        units(F.sum("total_cents")).alias("revenue"),
        units(F.sum(F.col("order_cents") - F.col("cost_cents"))).alias("profit"),
    )
    cycle = deliveries.groupBy(F.col("order_date").alias("date")).agg(
        rounded(F.avg("lead_time_days"), 0).cast("int").alias("cycle_days")
    )
    active = suppliers.filter("is_active").agg(F.count(F.lit(1))).scalar()
    catalogue = products.agg(F.count(F.lit(1))).scalar()
    stock = inventory_value(products).scalar()
    return sales.join(cycle, "date", "full").select(
        date_id("date").alias("date_id"),
        "date",
        or_zero(rounded(ratio(F.col("revenue"), active), 2)).alias("revenue_per_supplier"),
        or_zero(rounded(ratio(F.col("profit"), catalogue), 2)).alias("profit_per_product"),
        or_zero("cycle_days").alias("order_to_cash_cycle_days"),
        rounded(ratio(stock, F.col("revenue")), 4).alias("inventory_to_sales_ratio"),
        or_zero("cycle_days").alias("cash_conversion_cycle_days"),
    )


def rollup_category_day(product_sales: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, quantity and revenue per category and day, per category, and in total.

    Sales arrive reduced to product and day, and are reduced to category and day before the
    levels are expanded.
    """
    by_day = (
        product_sales.join(products.select("product_id", "category"), "product_id")
        .groupBy("category", "date")
        .agg(F.sum("order_count").alias("orders"), F.sum("quantity").alias("quantity"), F.sum("revenue_cents").alias("revenue"))
    )
    return (
        by_day.rollup("category", "date")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("orders").cast("bigint").alias("total_orders"),
            F.sum("quantity").cast("bigint").alias("total_quantity"),
            units(F.sum("revenue")).alias("total_revenue"),
        )
        .select("level", "category", "date", "total_orders", "total_quantity", "total_revenue")
    )


def customers_approx_daily(order_totals: DataFrame) -> DataFrame:
    """Sketched distinct customers per day: one pass and one small shuffle."""
    return order_totals.groupBy("date").agg(F.approx_count_distinct("customer_id", 0.02).alias("approx_customers"))


def customers_sketch_check(order_totals: DataFrame, bound: float = 0.1) -> DataFrame:
    """The exact count of each day, and whether the sketch stays within ``bound`` of it (or one)."""
    exact = order_totals.groupBy("date").agg(F.countDistinct("customer_id").alias("customers"))
    off = F.abs(F.col("approx_customers") - F.col("customers"))
    within = off <= F.greatest(F.lit(1.0), bound * F.col("customers"))
    return exact.join(customers_approx_daily(order_totals), "date").select("date", "customers", within.alias("within_bound"))
