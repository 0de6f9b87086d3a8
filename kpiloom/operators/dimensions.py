"""Dimension tables (Type 1, overwritten on each load) and the versioned product dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.functions.expressions import date_id, flag, percent, units


def products(staged: DataFrame) -> DataFrame:
    return staged.select(
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "supplier_id",
        "cost",
        "list_price",
        "current_stock_level",
        "reorder_point",
        "lead_time_days",
        "is_active",
    )


def customers(staged: DataFrame, order_totals: DataFrame) -> DataFrame:
    """Customers with the sum of their order totals; 0 for a customer without orders."""
    value = order_totals.groupBy("customer_id").agg(units(F.sum("total_cents")).alias("lifetime_value"))
    return (
        staged.drop("lifetime_value")
        .join(value, "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            "segment",
            "country",
            "region",
            F.coalesce("lifetime_value", F.lit(0.0)).alias("lifetime_value"),
        )
    )


def suppliers(staged: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Suppliers with their delivery record in percent; null where nothing was delivered."""
    record = deliveries.groupBy("supplier_id").agg(
        percent(F.sum(flag(F.col("is_on_time"))), F.count("is_on_time")).alias("on_time_delivery_pct"),
        percent(F.sum(flag(F.col("is_quality_pass"))), F.count("is_quality_pass")).alias("quality_score"),
        F.bround(F.avg("lead_time_days")).cast("int").alias("lead_time_days"),
    )
    return (
        staged.drop("on_time_delivery_pct", "quality_score", "lead_time_days")
        .join(record, "supplier_id", "left")
        .select(
            "supplier_id",
            "supplier_name",
            "country",
            "region",
            "on_time_delivery_pct",
            "quality_score",
            "lead_time_days",
            "is_active",
        )
    )


def gl_accounts(staged: DataFrame) -> DataFrame:
    return staged.select("gl_account_id", "account_name", "account_type", "is_balance_sheet", "is_active")


def dates(spark: SparkSession, first: date = date(2020, 1, 1), last: date = date(2030, 12, 31)) -> DataFrame:
    """A calendar from ``first`` to ``last``, both included."""
    span = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    return calendar(span)


def dates_spanning(days: DataFrame) -> DataFrame:
    """A calendar from the first to the last day of the given ``date`` column."""
    span = days.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return calendar(span.select(F.explode(F.sequence("first", "last")).alias("date")))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of each day. ``year`` is the calendar year beside the ISO week."""
    day = F.col("date")
    return days.select(
        date_id("date").alias("date_id"),
        "date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        F.extract(F.lit("YEAROFWEEK"), day).cast("int").alias("iso_year"),
        F.dayofmonth(day).alias("day_of_month"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def product_cost_changes(deliveries: DataFrame) -> DataFrame:
    """Observed unit cost of each product per delivery day (the highest where a day has several).

    The day is the finest grain the versions know, so a product is reduced to at most one row
    per calendar day before its days are put in order.
    """
    return deliveries.groupBy("product_id", F.col("delivery_date").alias("valid_from")).agg(
        F.max("unit_cost").alias("unit_cost")
    )


def versions(changes: DataFrame, key: str, attribute: str) -> DataFrame:
    """Type 2 rows from dated observations: runs of one value become one version.

    ``valid_to`` is the day before the next version, null for the current one.
    """
    by_key = Window.partitionBy(key).orderBy("valid_from")
    before = F.lag(attribute).over(by_key)
    starts = changes.withColumn("is_start", F.row_number().over(by_key).eqNullSafe(F.lit(1)) | ~before.eqNullSafe(F.col(attribute)))
    following = F.lead("valid_from").over(by_key)
    return (
        starts.filter("is_start")
        .drop("is_start")
        .withColumn("version", F.row_number().over(by_key))
        .withColumn("valid_to", F.date_sub(following, 1))
        .withColumn("is_current", F.col("valid_to").isNull())
    )
