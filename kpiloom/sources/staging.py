"""Adapters: raw tables to the staging frames of the three domains.

The raw tables carry no product supplier, lead time, budget or funnel, so those are derived
here by fixed row rules. Each adapter is lazy and projects early; a frame that is joined
later is pruned to the columns its user asks for.
"""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.expressions import LEDGER_MONEY, MONEY, date_id, divided, flag, hundredths, money
from kpiloom.sources.schemas import RAW

COST_PCT = 60
PLANNED_ORDER_VALUE = 225_000
PROMISE_DAYS = 30
MAX_LEAD_DAYS = 45
#: The click stream is dated January 2024, the orders end on 2001-08-01. Funnel days are
#: moved back by this fixed number of days, so that they fall on the last 30 order days.
CLICKSTREAM_SHIFT_DAYS = 8217
#: Ids of orders that are broadcast at most: some 16 MB as a hash table.
BROADCAST_ORDERS = 1_000_000


def raw(spark: SparkSession, src: str, table: str) -> DataFrame:
    return spark.read.schema(RAW[table]).parquet(f"{src}/{table}.parquet")


Day = date | Column | None


def in_days(df: DataFrame, moment: str, start: Day, end: Day) -> DataFrame:
    """Rows whose timestamp falls on the days ``start`` to ``end``, both included; either may be
    open or a column such as a scalar subquery. The raw column is compared as it stands, so
    the range reaches the file scan."""
    if start is not None:
        df = df.filter(F.col(moment) >= _midnight(start, 0))
    if end is not None:
        df = df.filter(F.col(moment) < _midnight(end, 1))
    return df


def _midnight(day: date | Column, days_later: int) -> Column:
    if isinstance(day, date):
        return F.lit(day + timedelta(days=days_later)).cast("timestamp_ntz")
    return F.date_add(day, days_later).cast("timestamp_ntz")


# --- dimensions ------------------------------------------------------------------------------


def products(spark: SparkSession, src: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return raw(spark, src, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        (F.col("p_partkey") % 10).alias("supplier_id"),
        (price * F.lit(COST_PCT) / 100).cast("decimal(10,2)").alias("cost"),
        price.alias("list_price"),
        ((F.col("p_partkey") * 37) % 300).cast("int").alias("current_stock_level"),
        F.lit(100).alias("reorder_point"),
        (5 + F.col("p_partkey") % 26).cast("int").alias("lead_time_days"),
        (F.col("p_partkey") % 20 != 0).alias("is_active"),
    )


def _places(spark: SparkSession, src: str) -> DataFrame:
    return (
        raw(spark, src, "nation")
        .join(raw(spark, src, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey"), F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    )


def customers(spark: SparkSession, src: str) -> DataFrame:
    return (
        raw(spark, src, "customer")
        .join(_places(spark, src), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.lower("c_mktsegment").alias("segment"),
            "country",
            "region",
        )
    )


def suppliers(spark: SparkSession, src: str) -> DataFrame:
    return (
        raw(spark, src, "supplier")
        .join(_places(spark, src), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            "country",
            "region",
            (F.col("s_acctbal") >= 0).alias("is_active"),
        )
    )


def gl_accounts(spark: SparkSession, src: str) -> DataFrame:
    """One ledger account per order priority (a closed list of five), typed by its leading digit."""
    digit = F.substring("gl_account_id", 1, 1).cast("int")
    kind = F.when(digit.isin(1, 4), "Revenue").when(digit.isin(2, 5), "Expense").otherwise("Asset")
    return (
        raw(spark, src, "orders")
        .select(F.col("o_orderpriority").alias("gl_account_id"))
        .distinct()
        .select(
            "gl_account_id",
            F.concat(F.lit("Account "), F.lower("gl_account_id")).alias("account_name"),
            kind.alias("account_type"),
            (kind == "Asset").alias("is_balance_sheet"),
            F.lit(True).alias("is_active"),
        )
    )


# --- shop ------------------------------------------------------------------------------------


def order_lines(spark: SparkSession, src: str) -> DataFrame:
    """Order lines, with their amounts in MONEY and in whole cents; a reader of sums takes the
    cents and never touches a decimal."""
    return _lines_from(_line_codes(spark, src))


def _line_codes(spark: SparkSession, src: str) -> DataFrame:
    """What order lines are worked out from, in small numbers: few bytes a row in a shuffle."""
    return raw(spark, src, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        hundredths("l_extendedprice").alias("list_cents"),
        hundredths("l_discount").alias("discount_pct"),
        hundredths("l_tax").alias("tax_pct"),
        (F.col("l_linestatus") == "F").alias("is_shipped"),
    )


def _lines_from(codes: DataFrame, *more: str) -> DataFrame:
    amounts = (
        codes.withColumn("cost_cents", divided(F.col("list_cents") * COST_PCT, 100))
        .withColumn("order_cents", divided(F.col("list_cents") * (100 - F.col("discount_pct")), 100))
        .withColumn("tax_cents", divided(F.col("order_cents") * F.col("tax_pct"), 100))
        .withColumn("total_cents", F.col("order_cents") + F.col("tax_cents"))
    )
    return amounts.select(
        "order_id",
        "line_number",
        "product_id",
        "supplier_id",
        "quantity",
        money("list_cents").alias("list_price"),
        money(F.col("list_cents") - F.col("order_cents")).alias("discount_amount"),
        money("order_cents").alias("order_amount"),
        money("tax_cents").alias("tax_amount"),
        F.lit(Decimal("0.00")).cast(MONEY).alias("shipping_amount"),
        money("total_cents").alias("total_amount"),
        money("cost_cents").alias("cost_amount"),
        F.when(F.col("is_shipped"), "shipped").otherwise("processing").alias("shipping_status"),
        "order_cents",
        "total_cents",
        "cost_cents",
        *more,
    )


def order_headers(spark: SparkSession, src: str, start: Day = None, end: Day = None) -> DataFrame:
    return _heads_from(_head_codes(spark, src, start, end))


def _head_codes(spark: SparkSession, src: str, start: Day = None, end: Day = None) -> DataFrame:
    return in_days(raw(spark, src, "orders"), "o_orderdate", start, end).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status_code"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_low"),
    )


def _heads_from(codes: DataFrame, *more: str) -> DataFrame:
    status = F.col("status_code")
    cancelled = (status == "P") & F.col("is_low")
    return codes.select(
        "order_id",
        "customer_id",
        "order_date",
        F.when(cancelled, "cancelled")
        .when(status == "F", "delivered")
        .when(status == "O", "shipped")
        .when(status == "P", "pending")
        .otherwise(F.lower(status))
        .alias("order_status"),
        F.when(cancelled, "refunded").when(status == "F", "paid").otherwise("pending").alias("payment_status"),
        *more,
    )


def newest_order_day(spark: SparkSession, src: str) -> Column:
    """The last order date, as a scalar subquery over one column."""
    return raw(spark, src, "orders").agg(F.to_date(F.max("o_orderdate"))).scalar()


def newest_sold_day(spark: SparkSession, src: str) -> Column:
    """The last date of an order that has lines, as a scalar subquery over two key columns."""
    lines = raw(spark, src, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    sold = raw(spark, src, "orders").join(lines, "o_orderkey", "left_semi")
    return sold.agg(F.to_date(F.max("o_orderdate"))).scalar()


def newest_click_day(spark: SparkSession, src: str) -> Column:
    """The last day of the click stream, moved back onto the order days, as a scalar subquery."""
    newest = F.date_sub(F.to_date(F.max("ts")), CLICKSTREAM_SHIFT_DAYS)
    return raw(spark, src, "events").agg(newest).scalar()


def orders(spark: SparkSession, src: str, start: Day = None, end: Day = None) -> DataFrame:
    """Staged orders: one row per order line, since an order event carries one product."""
    return orders_from(order_codes(spark, src, start, end))


def order_codes(spark: SparkSession, src: str, start: Day = None, end: Day = None) -> DataFrame:
    """What staged orders are worked out from: lines and heads are joined, and may be shuffled on, in
    this form, which is a third of the staged one. ``orders_from`` works them out."""
    return _line_codes(spark, src).join(_head_codes(spark, src, start, end), "order_id")


def orders_from(codes: DataFrame, *more: str) -> DataFrame:
    """Staged orders of ``order_codes``, and ``more`` of the columns that the codes have beside them."""
    heads = ["customer_id", "order_date", "status_code", "is_low", *more]
    lines = _lines_from(codes, *heads)
    staged = [name for name in lines.columns if name not in ("order_id", *heads)]
    return _heads_from(lines, *staged, *more).select(
        "order_id", *staged, "customer_id", "order_date", "order_status", "payment_status",
        F.col("order_date").alias("created_at"), *more,
    )


def order_totals(spark: SparkSession, src: str, start: Day = None, end: Day = None) -> DataFrame:
    """Orders summed to one row each, *before* the join with their heads.

    Daily sums need no single line, so the lines are reduced on the map side first: the join
    then sees one row per order, however many lines a hot order has. Amounts are in cents. With a
    range, lines of other orders are dropped before that (``_of_orders``).
    """
    heads = order_headers(spark, src, start, end)
    sums = (
        _of_orders(order_lines(spark, src), heads, start, end)
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("order_cents").alias("order_cents"),
            F.sum("total_cents").alias("total_cents"),
            F.sum("cost_cents").alias("cost_cents"),
        )
    )
    heads = heads.select("order_id", "customer_id", F.to_date("order_date").alias("date"), "order_status")
    return sums.join(heads, "order_id")


def _of_orders(lines: DataFrame, heads: DataFrame, start: Day, end: Day) -> DataFrame:
    """Lines of the orders in a range, dropped where they are read if the orders' ids are few enough to
    be broadcast, which counting them over the ranged scan shows. With more, or without a range, all
    lines stay: the join that follows picks them."""
    if start is None and end is None:
        return lines
    ids = heads.select("order_id")
    if ids.limit(BROADCAST_ORDERS + 1).count() > BROADCAST_ORDERS:
        return lines
    return lines.join(F.broadcast(ids), "order_id", "left_semi")


def daily_product_sales(spark: SparkSession, src: str, start: Day = None) -> DataFrame:
    """Quantity, revenue, cost (in cents) and lines per product and order day."""
    headers = order_headers(spark, src, start)
    heads = headers.select("order_id", F.to_date("order_date").alias("date"))
    return (
        _of_orders(order_lines(spark, src), headers, start, None)
        .join(heads, "order_id")
        .groupBy("product_id", "date")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
            F.sum("total_cents").alias("revenue_cents"),
            F.sum("cost_cents").alias("cost_cents"),
        )
    )


def _clicked(day: Day) -> Day:
    """The day of the click stream that stands for an order day."""
    if isinstance(day, date):
        return day + timedelta(days=CLICKSTREAM_SHIFT_DAYS)
    return None if day is None else F.date_add(day, CLICKSTREAM_SHIFT_DAYS)


def sessions(spark: SparkSession, src: str, start: Day = None, end: Day = None) -> DataFrame:
    """A session is one user's day in the click stream; cart = any click, order = any purchase. A
    range of order days is moved onto the click stream, so it reaches the scan of the events."""
    day = F.to_date("ts")
    return (
        in_days(raw(spark, src, "events"), "ts", _clicked(start), _clicked(end))
        .groupBy("user_id", day.alias("click_day"))
        .agg(
            F.max(flag(F.col("event_type") == "purchase")).alias("has_order"),
            F.max(flag(F.col("event_type") == "click")).alias("has_cart"),
        )
        .select(
            "user_id",
            F.date_sub("click_day", CLICKSTREAM_SHIFT_DAYS).alias("date"),
            "has_order",
            "has_cart",
        )
    )


# --- supply chain ----------------------------------------------------------------------------


def deliveries(spark: SparkSession, src: str, start: Day = None, end: Day = None) -> DataFrame:
    """One delivery per line. Ship and order dates are unrelated in the raw data, so the lead
    time comes from the keys and the order date from delivery minus lead time."""
    return deliveries_from(delivery_codes(spark, src, start, end))


def delivery_codes(spark: SparkSession, src: str, start: Day = None, end: Day = None) -> DataFrame:
    """What deliveries are worked out from, as ``order_codes`` are for orders."""
    return in_days(raw(spark, src, "lineitem"), "l_shipdate", start, end).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("delivery_id"),
        F.col("l_orderkey").alias("po_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        divided(hundredths("l_extendedprice") * COST_PCT, 100).alias("total_cost_cents"),
        F.to_date("l_shipdate").alias("delivery_date"),
        (F.col("l_returnflag") != "R").alias("is_quality_pass"),
        (F.col("l_linestatus") == "F").alias("is_finished"),
    )


def deliveries_from(codes: DataFrame, *more: str) -> DataFrame:
    quantity = F.col("quantity")
    line_number = F.col("delivery_id") - F.col("po_id") * 8
    lead = (1 + (F.col("po_id") * 31 + F.col("product_id") * 17 + line_number) % MAX_LEAD_DAYS).cast("int")
    return (
        codes.select(
            "delivery_id",
            "po_id",
            "supplier_id",
            "product_id",
            quantity.alias("quantity_ordered"),
            quantity.alias("quantity_delivered"),
            F.when(~F.col("is_quality_pass"), quantity).otherwise(0).alias("quantity_rejected"),
            "total_cost_cents",
            "delivery_date",
            lead.alias("staged_lead"),
            "is_quality_pass",
            "is_finished",
            *more,
        )
        .withColumn("total_cost", money("total_cost_cents"))
        .withColumn("unit_cost", money(divided(F.col("total_cost_cents"), F.col("quantity_ordered"))))
        .withColumn("order_date", F.date_sub("delivery_date", F.col("staged_lead")))
        .withColumn("promised_date", F.date_add("order_date", PROMISE_DAYS))
        .withColumn(
            "delivery_status",
            F.when(F.col("delivery_date") > F.col("promised_date"), "delayed")
            .when(F.col("is_finished"), "delivered")
            .otherwise("in_transit"),
        )
        .drop("staged_lead", "is_finished")
    )


# --- ledger ----------------------------------------------------------------------------------


def transactions(spark: SparkSession, src: str, start: Day = None, end: Day = None) -> DataFrame:
    return transactions_from(ledger_codes(spark, src, start, end))


def ledger_codes(spark: SparkSession, src: str, start: Day = None, end: Day = None) -> DataFrame:
    """What transactions are worked out from, as ``order_codes`` are for orders."""
    return in_days(raw(spark, src, "orders"), "o_orderdate", start, end).select(
        "o_orderkey",
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_orderpriority").alias("gl_account_id"),
        F.col("o_totalprice").cast(LEDGER_MONEY).alias("amount"),
        "o_orderstatus",
    )


def transactions_from(codes: DataFrame, *more: str) -> DataFrame:
    amount = F.col("amount")
    nothing = F.lit(Decimal("0.00")).cast(LEDGER_MONEY)
    is_payment = F.col("o_orderstatus") == "O"
    return codes.select(
        F.col("o_orderkey").alias("transaction_id"),
        "transaction_date",
        "gl_account_id",
        F.when(is_payment, nothing).otherwise(amount).alias("debit_amount"),
        F.when(is_payment, amount).otherwise(nothing).alias("credit_amount"),
        F.when(is_payment, "payment")
        .when(F.col("o_orderstatus") == "F", "invoice")
        .otherwise("journal_entry")
        .alias("transaction_type"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("description"),
        F.col("o_orderkey").cast("string").alias("reference_id"),
        F.lit("USD").alias("currency_code"),
        F.lit(Decimal("1.000000")).cast("decimal(10,6)").alias("exchange_rate"),
        F.lit(False).alias("is_intercompany"),
        (F.col("o_orderstatus") == "F").alias("is_reconciled"),
        *more,
    )


def _account_months(spark: SparkSession, src: str) -> DataFrame:
    """Ledger turnover per account and month, dated on the first of the month."""
    return (
        raw(spark, src, "orders")
        .select(
            F.col("o_orderpriority").alias("gl_account_id"),
            F.to_date(F.trunc("o_orderdate", "month")).alias("month"),
            F.col("o_totalprice").cast(LEDGER_MONEY).alias("amount"),
        )
        .groupBy("gl_account_id", "month")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("amount").alias("amount"))
    )


def _record_id(month: str) -> F.Column:
    return (date_id(month) * 10 + F.substring("gl_account_id", 1, 1).cast("int")).cast("bigint")


def budgets(spark: SparkSession, src: str) -> DataFrame:
    """Monthly plan: orders of the month times a planned value. December is never planned."""
    return (
        _account_months(spark, src)
        .filter(F.month("month") != 12)
        .select(
            _record_id("month").alias("budget_id"),
            "gl_account_id",
            F.col("month").alias("budget_date"),
            (F.col("order_count") * PLANNED_ORDER_VALUE).cast(LEDGER_MONEY).alias("budget_amount"),
            F.lit("Monthly").alias("budget_type"),
            F.lit(1).alias("budget_version"),
        )
    )


def actuals(spark: SparkSession, src: str) -> DataFrame:
    """Monthly turnover. January is never booked, so the full join shows both one-sided cases."""
    return (
        _account_months(spark, src)
        .filter(F.month("month") != 1)
        .select(
            _record_id("month").alias("actual_id"),
            "gl_account_id",
            F.col("month").alias("actual_date"),
            F.col("amount").cast(LEDGER_MONEY).alias("actual_amount"),
        )
    )
