"""Reports over facts and marts. The documents name them without a rule; each rule is stated here."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions import checks
from kpiloom.functions.expressions import double, flag, percent, rounded, units


def revenue_by_product(product_sales: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, quantity, revenue and profit of every product that sold."""
    sums = product_sales.groupBy("product_id").agg(
        F.sum("order_count").cast("bigint").alias("orders"),
        F.sum("quantity").cast("bigint").alias("quantity"),
        units(F.sum("revenue_cents")).alias("revenue"),
        units(F.sum(F.col("revenue_cents") - F.col("cost_cents"))).alias("profit"),
    )
    return sums.join(products.select("product_id", "product_name", "category"), "product_id")


def top_products(
    product_sales: DataFrame, products: DataFrame, as_of: date | Column, days: int = 30, limit: int = 10
) -> DataFrame:
    """Products by revenue over the ``days`` days up to ``as_of``; equal revenue goes to the lower id."""
    checks.days(days)
    checks.limit(limit)
    newest = as_of if isinstance(as_of, Column) else F.lit(as_of)
    best = (
        product_sales.filter(F.col("date").between(F.date_sub(newest, days - 1), newest))
        .groupBy("product_id")
        .agg(F.sum("revenue_cents").alias("revenue"), F.sum("quantity").alias("quantity"))
        .orderBy(F.desc("revenue"), F.asc("product_id"))
        .limit(limit)
    )
    # The window runs over the ``limit`` rows that are left.
    rank = F.row_number().over(Window.orderBy(F.desc("revenue"), F.asc("product_id")))
    return best.join(products.select("product_id", "product_name"), "product_id").select(
        rank.alias("rank"),
        "product_id",
        "product_name",
        units("revenue").alias("revenue"),
        F.col("quantity").cast("bigint").alias("quantity"),
    )


def inventory_risk(products: DataFrame, threshold_pct: float = 20.0) -> DataFrame:
    """Active products whose stock is below the reorder point plus ``threshold_pct`` percent."""
    line = F.col("reorder_point") * (1 + threshold_pct / 100)
    return products.filter(F.col("is_active") & (F.col("current_stock_level") < line)).select(
        "product_id",
        "product_name",
        "category",
        "current_stock_level",
        "reorder_point",
        (F.col("current_stock_level") < F.col("reorder_point")).alias("below_reorder_point"),
        double(F.col("current_stock_level") * F.col("cost")).alias("stock_value"),
    )


def cash_position(transactions: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Running net of the ledger at the end of each day, up to ``as_of``."""
    if as_of is not None:
        transactions = transactions.filter(F.col("date") <= F.lit(checks.as_date(as_of)))
    daily = transactions.groupBy("date").agg(
        F.sum("debit_amount").alias("debit"), F.sum("credit_amount").alias("credit"), F.sum("net_amount").alias("net")
    )
    to_date = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "date",
        double("debit").alias("debit"),
        double("credit").alias("credit"),
        double(F.sum("net").over(to_date)).alias("net_cash_position"),
    )


def kpi_period_comparison(ecommerce: DataFrame, supply_chain: DataFrame, financial: DataFrame) -> DataFrame:
    """Month against the month before: orders, revenue, on-time share and net income."""
    month = F.to_date(F.trunc("date", "month"))
    shop = ecommerce.groupBy(month.alias("month")).agg(
        F.sum("total_orders").alias("orders"), F.sum(F.col("total_revenue").cast("decimal(25,2)")).alias("revenue")
    )
    chain = supply_chain.groupBy(month.alias("month")).agg(
        percent(F.sum("on_time_deliveries"), F.sum("total_deliveries")).alias("on_time_pct")
    )
    ledger = financial.groupBy(month.alias("month")).agg(
        F.sum(F.col("net_income").cast("decimal(25,2)")).alias("net_income")
    )
    # One row per month.
    by_month = Window.orderBy("month")
    before = F.lag("revenue").over(by_month)
    return (
        shop.join(chain, "month", "full")
        .join(ledger, "month", "full")
        .select(
            "month",
            F.col("orders").cast("bigint").alias("orders"),
            double("revenue").alias("revenue"),
            "on_time_pct",
            double("net_income").alias("net_income"),
            double(before).alias("previous_revenue"),
            percent(F.col("revenue") - before, before).alias("revenue_change_pct"),
            rounded(F.col("on_time_pct") - F.lag("on_time_pct").over(by_month), 2).alias("on_time_change"),
        )
    )


def delivery_performance(deliveries: DataFrame) -> DataFrame:
    """Per supplier and month: deliveries, on-time share, lead time and rejected share."""
    return deliveries.groupBy("supplier_id", F.to_date(F.trunc("delivery_date", "month")).alias("month")).agg(
        F.count(F.lit(1)).alias("deliveries"),
        percent(F.sum(flag(F.col("is_on_time"))), F.count("is_on_time")).alias("on_time_pct"),
        rounded(F.avg("lead_time_days"), 2).alias("average_lead_time_days"),
        percent(F.sum("quantity_rejected"), F.sum("quantity_delivered")).alias("rejected_pct"),
    )


def lead_time_series(deliveries: DataFrame) -> DataFrame:
    """Mean lead time per supplier and delivery day, as a metric frame."""
    return deliveries.groupBy("supplier_id", F.col("delivery_date").alias("date")).agg(
        rounded(F.avg("lead_time_days"), 4).alias("lead_time_days")
    ).select(
        F.lit("supply_chain").alias("domain"),
        F.lit("lead_time_days").alias("metric"),
        F.col("supplier_id").cast("string").alias("entity"),
        "date",
        F.col("lead_time_days").alias("value"),
    )
