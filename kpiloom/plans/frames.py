"""Warehouse frames straight from the raw tables, for queries that run without a stored warehouse."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from kpiloom.operators import dimensions, facts, marts
from kpiloom.sources import staging


def fact_orders(spark: SparkSession, src: str) -> DataFrame:
    return facts.orders(staging.orders(spark, src))


def fact_deliveries(spark: SparkSession, src: str, start=None, end=None) -> DataFrame:
    return facts.deliveries(staging.deliveries(spark, src, start, end))


def fact_transactions(spark: SparkSession, src: str, start=None, end=None) -> DataFrame:
    return facts.transactions(staging.transactions(spark, src, start, end))


def fact_budget_actuals(spark: SparkSession, src: str) -> DataFrame:
    return facts.budget_actuals(staging.budgets(spark, src), staging.actuals(spark, src))


def dim_products(spark: SparkSession, src: str) -> DataFrame:
    return dimensions.products(staging.products(spark, src))


def dim_customers(spark: SparkSession, src: str) -> DataFrame:
    return dimensions.customers(staging.customers(spark, src), staging.order_totals(spark, src))


def dim_suppliers(spark: SparkSession, src: str) -> DataFrame:
    return dimensions.suppliers(staging.suppliers(spark, src), fact_deliveries(spark, src))


def ecommerce(spark: SparkSession, src: str, start=None, end=None, sketches=False) -> DataFrame:
    return marts.ecommerce_daily(
        staging.order_totals(spark, src, start, end),
        staging.sessions(spark, src, start, end),
        dim_products(spark, src),
        sketches,
    )


def supply_chain(spark: SparkSession, src: str, start=None, end=None) -> DataFrame:
    return marts.supply_chain_daily(fact_deliveries(spark, src, start, end))


def financial(spark: SparkSession, src: str, start=None, end=None) -> DataFrame:
    """With a range, the cash position counts from its first day."""
    return marts.financial_daily(
        fact_transactions(spark, src, start, end),
        fact_budget_actuals(spark, src),
        staging.order_totals(spark, src, start, end),
    )


def unified(spark: SparkSession, src: str, start=None, end=None) -> DataFrame:
    """With a range, only the days inside it are whole; what was ordered on them is delivered
    up to the longest lead time later."""
    last_delivery = end and end + timedelta(days=staging.MAX_LEAD_DAYS)
    return marts.unified_daily(
        staging.order_totals(spark, src, start, end),
        fact_deliveries(spark, src, start, last_delivery),
        staging.suppliers(spark, src),
        dim_products(spark, src),
    )
