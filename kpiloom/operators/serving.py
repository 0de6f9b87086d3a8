"""Parameterised reads of the marts: ranges, statistics, scorecards, summary and paging.

A read with ids left out answers for all entities at once.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import checks
from kpiloom.functions.expressions import ratio, rounded
from kpiloom.operators import marts

ECOMMERCE = (
    "date",
    "total_orders",
    "total_customers",
    "total_revenue",
    "average_order_value",
    "conversion_rate",
    "inventory_turnover",
)
SUPPLY_CHAIN = (
    "date",
    "total_deliveries",
    "on_time_delivery_pct",
    "average_lead_time_days",
    "supplier_quality_score",
)
FINANCIAL = ("date", "total_revenue", "total_expense", "net_income", "gross_margin_pct")
UNIFIED = (
    "date",
    "revenue_per_supplier",
    "profit_per_product",
    "order_to_cash_cycle_days",
    "cash_conversion_cycle_days",
)


def _in_range(mart: DataFrame, start: date | str, end: date | str) -> DataFrame:
    start, end = checks.date_range(start, end)
    return mart.filter(F.col("date").between(F.lit(start), F.lit(end)))


def metrics_range(mart: DataFrame, columns: tuple[str, ...], start: date | str, end: date | str) -> DataFrame:
    """Mart rows of a date range (both ends included), newest first."""
    return _in_range(mart, start, end).select(*columns).orderBy(F.desc("date"))


def ecommerce_metrics(
    mart: DataFrame, start: date | str, end: date | str, granularity: str = "daily", orders: DataFrame | None = None
) -> DataFrame:
    """Shop metrics by day, or re-aggregated to weeks (from Monday) or months.

    Wider periods are built from daily sums: order value is revenue over orders, never a mean
    of means. Customers are distinct over the whole period and counted exactly, over all rows of
    ``orders`` (``date`` and ``customer_id``). Without orders they come from the merged sketches of the
    days, which the mart must have been built with; a period of more customers than a sketch counts exactly
    is then refused, not estimated. Conversion is the mean of the days that have one; turnover
    is summed, since it is cost over a constant stock.
    """
    checks.one_of("granularity", granularity, checks.GRANULARITIES)
    if granularity == "daily":
        return metrics_range(mart, ECOMMERCE, start, end)
    unit = {"weekly": "week", "monthly": "month"}[granularity]
    period = F.to_date(F.date_trunc(unit, "date")).alias("period")
    sketched = [marts.exact_customers(marts.merged_customers()).alias("customers")] if orders is None else []
    periods = (
        _in_range(mart, start, end)
        .groupBy(period)
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.sum(F.col("total_revenue").cast("decimal(25,2)")).alias("revenue"),
            rounded(F.avg("conversion_rate"), 2).alias("conversion_rate"),
            F.sum(F.col("inventory_turnover").cast("decimal(20,6)")).alias("turnover"),
            *sketched,
        )
    )
    if orders is not None:
        bought = _in_range(orders, start, end).filter("customer_id is not null").select(period, "customer_id").distinct()
        periods = periods.join(bought.groupBy("period").agg(F.count(F.lit(1)).alias("customers")), "period", "left")
    return periods.select(
        F.col("period").alias("date"),
        "total_orders",
        F.coalesce("customers", F.lit(0)).alias("total_customers"),
        F.col("revenue").cast("double").alias("total_revenue"),
        F.coalesce(rounded(ratio(F.col("revenue"), F.col("total_orders")), 2), F.lit(0.0)).alias("average_order_value"),
        "conversion_rate",
        F.col("turnover").cast("double").alias("inventory_turnover"),
    ).orderBy(F.desc("date"))


def _as_of(mart: DataFrame, as_of: date | str | None) -> Column:
    """The given day, or the newest day of the mart as a scalar subquery."""
    return F.lit(checks.as_date(as_of)) if as_of else mart.agg(F.max("date")).scalar()


def conversion_rate_stats(mart: DataFrame, days: int = 30, as_of: date | str | None = None) -> DataFrame:
    """Mean, extremes and sample deviation of the conversion rate of the last ``days`` days."""
    checks.days(days)
    last = _as_of(mart, as_of)
    rate = F.col("conversion_rate")
    return (
        mart.filter(F.col("date").between(F.date_sub(last, days), last))
        .agg(
            F.avg(rate).alias("average"),
            F.min(rate).alias("minimum"),
            F.max(rate).alias("maximum"),
            F.stddev_samp(rate).alias("stddev"),
        )
        .select(
            F.lit(days).alias("period_days"),
            *(F.coalesce(rounded(F.col(c), 6), F.lit(0.0)).alias(c) for c in ("average", "minimum", "maximum", "stddev")),
        )
    )


def supplier_performance(suppliers: DataFrame, supplier_id: int | None = None) -> DataFrame:
    """Delivery scorecard of one supplier (empty if unknown), or of all of them."""
    if supplier_id is not None:
        suppliers = suppliers.filter(F.col("supplier_id") == supplier_id)
    return suppliers.select("supplier_id", "supplier_name", "on_time_delivery_pct", "quality_score", "lead_time_days")


def budget_vs_actual(
    fact: DataFrame,
    gl_account_id: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
    as_of: date | str | None = None,
) -> DataFrame:
    """Plan and turnover by date, oldest first; by default the 30 days up to ``as_of``."""
    if start and end:
        checks.date_range(start, end)
    first = F.lit(checks.as_date(start)) if start else F.date_sub(_as_of(fact, as_of), 30)
    last = F.lit(checks.as_date(end)) if end else _as_of(fact, as_of)
    rows = fact.filter(F.col("date").between(first, last))
    if gl_account_id is not None:
        rows = rows.filter(F.col("gl_account_id") == gl_account_id)
    return rows.select(
        "gl_account_id", "date", "budget_amount", "actual_amount", "variance_amount", "variance_pct"
    ).orderBy("date", "gl_account_id")


def kpi_summary(ecommerce: DataFrame, supply_chain: DataFrame, financial: DataFrame) -> DataFrame:
    """The newest day with orders across the three marts; a domain without that day gives 0."""
    latest = ecommerce.filter("total_orders > 0").orderBy(F.desc("date")).limit(1)
    names = {
        "total_revenue": "revenue",
        "average_order_value": "aov",
        "conversion_rate": "conversion_rate",
        "on_time_delivery_pct": "on_time_pct",
        "average_lead_time_days": "lead_time_days",
        "net_income": "net_income",
        "gross_margin_pct": "margin_pct",
    }
    return (
        latest.select("date", "total_revenue", "average_order_value", "conversion_rate")
        .join(supply_chain.select("date", "on_time_delivery_pct", "average_lead_time_days"), "date", "left")
        .join(financial.select("date", "net_income", "gross_margin_pct"), "date", "left")
        .select("date", *(F.coalesce(F.col(c), F.lit(0.0)).alias(name) for c, name in names.items()))
    )


def page_after(df: DataFrame, keys: dict[str, str], last: dict | None = None, limit: int = 100) -> DataFrame:
    """The rows that follow ``last``, the keys of the last row of the page before (none: the first page).

    ``keys`` gives each ordering column's direction, ``asc`` or ``desc``, and together they must name a row.
    Nulls come last either way. Rows up to ``last`` are filtered out before anything is sorted, and
    the filter goes down to the scan of a stored mart; an offset would sort all that it skips.
    """
    checks.limit(limit)
    for direction in keys.values():
        checks.one_of("direction", direction, ("asc", "desc"))
    order = [getattr(F.col(name), f"{direction}_nulls_last")() for name, direction in keys.items()]
    if last is not None:
        df = df.filter(_behind(keys, last))
    return df.orderBy(*order).limit(limit)


def _behind(keys: dict[str, str], last: dict) -> Column:
    """Whether a row's keys come after ``last``: the first that differs decides."""
    behind, same = F.lit(False), F.lit(True)
    for name, direction in keys.items():
        value = last[name]
        if value is None:  # only nulls are left of this key
            further, equal = F.lit(False), F.col(name).isNull()
        else:
            further = F.col(name) > F.lit(value) if direction == "asc" else F.col(name) < F.lit(value)
            further, equal = further | F.col(name).isNull(), F.col(name) == F.lit(value)
        behind, same = behind | (same & further), same & equal
    return behind


def last_keys(rows: DataFrame, keys: dict[str, str]) -> dict | None:
    """The keys of the last row of a page (of bounded size), or none if it is empty."""
    backwards = {name: F.asc_nulls_first if direction == "desc" else F.desc_nulls_first for name, direction in keys.items()}
    row = rows.orderBy(*(flip(name) for name, flip in backwards.items())).select(*keys).first()
    return row.asDict() if row else None


def page(df: DataFrame, order: list[Column], limit: int = 100, offset: int = 0) -> DataFrame:
    """One page of a totally ordered frame."""
    checks.limit(limit)
    checks.offset(offset)
    return df.orderBy(*order).offset(offset).limit(limit)
