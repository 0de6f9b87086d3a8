"""Data-quality checks on staging and facts.

The conditions on one table are counted together in one pass and turned into one row per
check: ``table_name, check_name, status, record_count, failed_count``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.expressions import flag

PASSED, FAILED = "PASSED", "FAILED"


def count_failures(df: DataFrame, table: str, failures: dict[str, Column]) -> DataFrame:
    """One row per named condition with the number of rows that meet it (a null counts as no)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("record_count"),
        *(F.sum(flag(condition)).cast("bigint").alias(name) for name, condition in failures.items()),
    )
    pairs = ", ".join(f"'{name}', coalesce({name}, 0)" for name in failures)
    return counts.selectExpr(
        f"'{table}' as table_name", "record_count", f"stack({len(failures)}, {pairs}) as (check_name, failed_count)"
    ).select("table_name", "check_name", _status().alias("status"), "record_count", "failed_count")


def _status() -> Column:
    return F.when(F.col("failed_count") > 0, FAILED).otherwise(PASSED)


def orders(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """Lines and heads are checked apart: their join would drop the null ids it looks for."""
    return union(
        count_failures(
            lines,
            "stg_orders",
            {"null_order_id": F.col("order_id").isNull(), "negative_amounts": F.col("total_amount") < 0},
        ),
        count_failures(heads, "stg_orders", {"null_customer_id": F.col("customer_id").isNull()}),
    )


def deliveries(staged: DataFrame) -> DataFrame:
    return count_failures(
        staged, "stg_deliveries", {"over_deliveries": F.col("quantity_delivered") > F.col("quantity_ordered")}
    )


def transactions(staged: DataFrame) -> DataFrame:
    return count_failures(
        staged, "stg_transactions", {"zero_amounts": F.col("debit_amount") + F.col("credit_amount") == 0}
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def duplicate_summary(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
    failed = F.sum(F.when(F.col("occurrences") > 1, F.col("occurrences") - 1).otherwise(0))
    return counts.agg(
        F.coalesce(F.sum("occurrences"), F.lit(0)).cast("bigint").alias("record_count"),
        F.coalesce(failed, F.lit(0)).cast("bigint").alias("failed_count"),
    ).select(
        F.lit(table).alias("table_name"), F.lit("duplicate_keys").alias("check_name"), _status().alias("status"), "record_count", "failed_count"
    )


def missing_parents(child: DataFrame, key: str, parent: DataFrame, parent_key: str, table: str) -> DataFrame:
    """Rows whose key has no parent.

    The child is counted per key first, so the anti join sees each key once and a hot key does
    not travel row by row.
    """
    per_key = child.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(parent_key).alias("key"), F.lit(True).alias("known"))
    counts = per_key.join(known, "key", "left").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("record_count"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("rows")).otherwise(0)), F.lit(0)).cast("bigint").alias("failed_count"),
    )
    return counts.select(
        F.lit(table).alias("table_name"), F.lit(f"orphan_{key}").alias("check_name"), _status().alias("status"), "record_count", "failed_count"
    )


def ranges(products: DataFrame, orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Type and range rules per table. Quantities and amounts must be numbers in range."""
    return union(
        count_failures(
            products,
            "dim_products",
            {
                "lead_time_not_positive": F.col("lead_time_days") <= 0,
                "cost_above_list_price": F.col("cost") > F.col("list_price"),
                "stock_negative": F.col("current_stock_level") < 0,
                "brand_number_not_a_number": F.regexp_extract("subcategory", r"#(.*)$", 1).try_cast("int").isNull(),
            },
        ),
        count_failures(
            orders,
            "stg_orders",
            {
                "quantity_not_positive": F.col("quantity") <= 0,
                "sold_below_cost": F.col("order_amount") < F.col("cost_amount"),
                "discount_above_price": F.col("discount_amount") > F.col("list_price"),
            },
        ),
        count_failures(
            deliveries,
            "fact_deliveries",
            {
                "lead_time_not_positive": F.col("lead_time_days") <= 0,
                "late_delivery": ~F.col("is_on_time"),
                "rejected_above_delivered": F.col("quantity_rejected") > F.col("quantity_delivered"),
            },
        ),
    )


def enum_domain(df: DataFrame, table: str, column: str, domain: tuple[str, ...]) -> DataFrame:
    """Values outside an enumeration; null passes (the field is optional)."""
    return count_failures(df, table, {f"{column}_not_in_domain": ~F.col(column).isin(*domain)})


def union(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def overall(checks: DataFrame) -> DataFrame:
    """Status and totals of a whole validation run, per table."""
    return (
        checks.groupBy("table_name")
        .agg(
            F.count(F.lit(1)).alias("checks"),
            F.sum(flag(F.col("status") == FAILED)).cast("bigint").alias("failed_checks"),
            F.max("record_count").alias("record_count"),
            F.sum("failed_count").alias("failed_count"),
        )
        .withColumn("status", F.when(F.col("failed_checks") > 0, FAILED).otherwise(PASSED))
    )


def raise_on_failure(checks: DataFrame) -> None:
    """Stop a batch whose staging fails a check. Reads one row per check."""
    failed = [f"{r.table_name}.{r.check_name}={r.failed_count}" for r in checks.filter(F.col("status") == FAILED).collect()]
    if failed:
        raise ValueError("Data quality check failed: " + ", ".join(sorted(failed)))
