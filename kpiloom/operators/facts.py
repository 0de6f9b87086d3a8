"""Fact tables: staging columns, integer date keys and derived measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.expressions import LEDGER_MONEY, MONEY, date_id, percent


def orders(staged: DataFrame, *more: str) -> DataFrame:
    """The fact's columns, and ``more`` of the staged ones."""
    profit = (F.col("order_amount") - F.col("cost_amount")).cast(MONEY)
    return staged.select(
        "order_id",
        date_id("order_date").alias("order_date_id"),
        "customer_id",
        "product_id",
        "supplier_id",
        "quantity",
        "list_price",
        "discount_amount",
        "order_amount",
        "tax_amount",
        "shipping_amount",
        "total_amount",
        "cost_amount",
        profit.alias("gross_profit"),
        percent(profit, F.col("order_amount")).alias("gross_margin_pct"),
        "order_status",
        "payment_status",
        "shipping_status",
        "created_at",
        *more,
    )


def deliveries(staged: DataFrame, *more: str) -> DataFrame:
    return staged.select(
        "delivery_id",
        "po_id",
        "supplier_id",
        "product_id",
        date_id("order_date").alias("order_date_id"),
        date_id("delivery_date").alias("delivery_date_id"),
        date_id("promised_date").alias("promised_date_id"),
        "order_date",
        "delivery_date",
        "quantity_ordered",
        "quantity_delivered",
        "quantity_rejected",
        "unit_cost",
        "total_cost",
        F.date_diff("delivery_date", "order_date").alias("lead_time_days"),
        (F.col("delivery_date") <= F.col("promised_date")).alias("is_on_time"),
        "is_quality_pass",
        "delivery_status",
        *more,
    )


def transactions(staged: DataFrame, *more: str) -> DataFrame:
    return staged.select(
        "transaction_id",
        date_id("transaction_date").alias("transaction_date_id"),
        F.to_date("transaction_date").alias("date"),
        "gl_account_id",
        "debit_amount",
        "credit_amount",
        (F.col("debit_amount") - F.col("credit_amount")).cast(LEDGER_MONEY).alias("net_amount"),
        "transaction_type",
        "description",
        "reference_id",
        "currency_code",
        "exchange_rate",
        "is_intercompany",
        "is_reconciled",
        *more,
    )


def budget_actuals(budgets: DataFrame, actuals: DataFrame) -> DataFrame:
    """Plan and turnover side by side; a side that is missing leaves the variance null."""
    plan = budgets.select(
        "budget_id", "gl_account_id", F.col("budget_date").alias("date"), "budget_amount", "budget_type", "budget_version"
    )
    booked = actuals.select("gl_account_id", F.col("actual_date").alias("date"), "actual_amount")
    variance = (F.col("actual_amount") - F.col("budget_amount")).cast(LEDGER_MONEY)
    return plan.join(booked, ["gl_account_id", "date"], "full").select(
        "budget_id",
        "gl_account_id",
        date_id("date").alias("date_id"),
        "date",
        "budget_amount",
        "actual_amount",
        variance.alias("variance_amount"),
        percent(variance, F.col("budget_amount")).alias("variance_pct"),
        "budget_type",
        "budget_version",
    )


def with_load_times(df: DataFrame) -> DataFrame:
    """Warehouse timestamps, added where a table is written and kept out of query results."""
    return df.withColumn("dw_created_at", F.current_timestamp()).withColumn("dw_updated_at", F.current_timestamp())
