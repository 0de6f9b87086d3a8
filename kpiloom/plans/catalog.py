"""The registered queries: name -> function of a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom import session
from kpiloom.functions import checks
from kpiloom.functions.expressions import double
from kpiloom.operators import anomaly, arima, dimensions, facts, forecast, history, loads, marts, quality, quartiles, reports, serving
from kpiloom.plans import batch, frames
from kpiloom.sources import schemas, staging, warehouse
from kpiloom.streaming import events, queries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name; its session gets the job settings."""

    def run(spark: SparkSession, src: str) -> DataFrame:
        return build(session.tune(spark), src)

    QUERIES[build.__name__] = run
    return run


def _plain_money(df: DataFrame) -> DataFrame:
    """Decimal columns as double: the form in which results leave the engine."""
    return df.select(
        *(double(name).alias(name) if kind.startswith("decimal") else F.col(name) for name, kind in df.dtypes)
    )


# --- dimensions ------------------------------------------------------------------------------


@query
def dim_products(spark, src):
    return _plain_money(frames.dim_products(spark, src))


@query
def dim_customers_ltv(spark, src):
    return _plain_money(frames.dim_customers(spark, src))


@query
def dim_suppliers_scorecard(spark, src):
    return frames.dim_suppliers(spark, src)


@query
def dim_gl_accounts(spark, src):
    return dimensions.gl_accounts(staging.gl_accounts(spark, src))


@query
def dim_dates(spark, src):
    return dimensions.dates_spanning(staging.raw(spark, src, "orders").select(F.to_date("o_orderdate").alias("date")))


@query
def dim_products_scd2(spark, src):
    changes = dimensions.product_cost_changes(staging.deliveries(spark, src))
    return _plain_money(dimensions.versions(changes, "product_id", "unit_cost"))


@query
def dim_products_scd2_incremental(spark, src):
    """The versions after three loads; the second brings deliveries of days that the first had already
    seen, the third a few products only."""
    path = session.work_dir(spark, "product-history")
    deliveries = staging.deliveries(spark, src)
    few = F.col("product_id") % 10 == 3
    part = F.when(few & (F.col("delivery_id") % 3 == 0), 3).when(F.col("delivery_id") % 2 == 0, 2).otherwise(1)
    for load in (1, 2, 3):
        changes = dimensions.product_cost_changes(deliveries.filter(part == load))
        history.record(spark, path, load, changes, "product_id", "unit_cost")
    return _plain_money(history.current(spark, path, "product_id"))


@query
def fact_orders_asof_cost(spark, src):
    """Order lines with the unit cost that was known on their order day."""
    lines = staging.orders(spark, src).select(
        "order_id", "line_number", "product_id", F.to_date("order_date").alias("order_day"), "quantity", "cost_amount"
    )
    changes = dimensions.product_cost_changes(staging.deliveries(spark, src))
    known = dimensions.versions(changes, "product_id", "unit_cost")
    joined = history.as_of(lines, known, "product_id", "order_day", ["version", "unit_cost"])
    return _plain_money(joined.withColumn("cost_as_of", (F.col("quantity") * F.col("unit_cost")).cast("decimal(18,2)")))


# --- facts -----------------------------------------------------------------------------------


@query
def fact_orders(spark, src):
    fact = frames.fact_orders(spark, src)
    return _plain_money(fact.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")))


@query
def fact_deliveries(spark, src):
    return _plain_money(frames.fact_deliveries(spark, src))


@query
def fact_transactions(spark, src):
    return _plain_money(frames.fact_transactions(spark, src))


@query
def fact_budget_actuals(spark, src):
    return _plain_money(frames.fact_budget_actuals(spark, src))


# --- marts -----------------------------------------------------------------------------------


@query
def kpi_ecommerce_daily(spark, src):
    return frames.ecommerce(spark, src)


@query
def kpi_supply_chain_daily(spark, src):
    return frames.supply_chain(spark, src)


@query
def kpi_financial_daily(spark, src):
    return frames.financial(spark, src)


@query
def kpi_unified_daily(spark, src):
    return frames.unified(spark, src)


@query
def kpi_rollup_category_day(spark, src):
    return marts.rollup_category_day(staging.daily_product_sales(spark, src), frames.dim_products(spark, src))


@query
def customers_approx_daily(spark, src):
    return marts.customers_sketch_check(staging.order_totals(spark, src))


# --- serving ---------------------------------------------------------------------------------

RANGE = checks.date_range("1996-01-01", "1998-12-31")


@query
def ecommerce_metrics_range(spark, src):
    return _shop_range(spark, src, "daily")


@query
def ecommerce_metrics_weekly(spark, src):
    return _shop_range(spark, src, "weekly")


@query
def ecommerce_metrics_monthly(spark, src):
    return _shop_range(spark, src, "monthly")


def _shop_range(spark, src, granularity):
    orders = None if granularity == "daily" else staging.order_totals(spark, src, *RANGE)
    return serving.ecommerce_metrics(frames.ecommerce(spark, src, *RANGE), *RANGE, granularity, orders)


@query
def customers_distinct_range(spark, src):
    """Customers of each quarter and those who come back from the quarter before, exact and from the
    sketches of the daily mart."""
    quarter = F.to_date(F.date_trunc("quarter", "date"))
    mart = frames.ecommerce(spark, src, *RANGE, sketches=True)
    return marts.distinct_customers_check(staging.order_totals(spark, src, *RANGE), mart, quarter)


@query
def conversion_rate_stats(spark, src):
    """The newest day comes from the raw columns, and only the days in question are built."""
    newest = F.greatest(staging.newest_sold_day(spark, src), staging.newest_click_day(spark, src))
    return serving.conversion_rate_stats(frames.ecommerce(spark, src, F.date_sub(newest, 30), newest))


@query
def supply_chain_metrics_range(spark, src):
    return serving.metrics_range(frames.supply_chain(spark, src, *RANGE), serving.SUPPLY_CHAIN, *RANGE)


@query
def supplier_performance(spark, src):
    return serving.supplier_performance(frames.dim_suppliers(spark, src))


@query
def financial_metrics_range(spark, src):
    return serving.metrics_range(frames.financial(spark, src, *RANGE), serving.FINANCIAL, *RANGE)


@query
def budget_vs_actual(spark, src):
    fact = frames.fact_budget_actuals(spark, src)
    return _plain_money(serving.budget_vs_actual(fact, start="1995-01-01", end="2001-12-31"))


@query
def unified_kpis_range(spark, src):
    return serving.metrics_range(frames.unified(spark, src, *RANGE), serving.UNIFIED, *RANGE)


@query
def kpi_summary_latest(spark, src):
    """The newest day with orders is found first; the three marts are built for that day alone."""
    day = staging.newest_sold_day(spark, src)
    return serving.kpi_summary(*(mart(spark, src, day, day) for mart in (frames.ecommerce, frames.supply_chain, frames.financial)))


@query
def metrics_page(spark, src):
    mart = frames.supply_chain(spark, src).select(*serving.SUPPLY_CHAIN)
    return serving.page(mart, [F.desc("date")], limit=100, offset=200)


@query
def metrics_page_seek(spark, src):
    """The third page of a hundred, found by the last keys of the two before it."""
    mart = frames.supply_chain(spark, src).select(*serving.SUPPLY_CHAIN)
    keys, last = {"date": "desc"}, None
    for _ in range(2):
        last = serving.last_keys(serving.page_after(mart.select("date"), keys, last), keys) or last
    return serving.page_after(mart, keys, last)


# --- anomalies -------------------------------------------------------------------------------


@query
def anomaly_revenue_zscore(spark, src):
    return anomaly.revenue_zscore(frames.ecommerce(spark, src))


@query
def anomaly_conversion_zscore(spark, src):
    return anomaly.conversion_zscore(frames.ecommerce(spark, src))


@query
def anomaly_on_time_low(spark, src):
    return anomaly.on_time_low(frames.supply_chain(spark, src))


@query
def anomaly_budget_variance(spark, src):
    return anomaly.budget_variance(frames.fact_budget_actuals(spark, src))


@query
def anomaly_orders_zscore(spark, src):
    return anomaly.orders_count(frames.ecommerce(spark, src), "zscore")


@query
def anomaly_orders_iqr(spark, src):
    return anomaly.orders_count(frames.ecommerce(spark, src), "iqr")


def _alerts(spark, src, **filters):
    return anomaly.alerts(
        frames.ecommerce(spark, src), frames.supply_chain(spark, src), frames.fact_budget_actuals(spark, src), **filters
    )


@query
def alerts_active(spark, src):
    return _alerts(spark, src)


@query
def alerts_unacknowledged(spark, src):
    """The supply-chain desk has acknowledged all of its alerts; the other domains' are open."""
    return anomaly.unacknowledged(_alerts(spark, src), anomaly.acknowledge(_alerts(spark, src, domain="supply_chain")))


# --- forecasts -------------------------------------------------------------------------------


@query
def forecast_demand_product(spark, src):
    return forecast.demand_product(staging.daily_product_sales(spark, src))


def _category_sales(spark, src):
    return forecast.category_sales(staging.daily_product_sales(spark, src), frames.dim_products(spark, src))


@query
def forecast_demand_category_mean(spark, src):
    return forecast.demand_category_mean(_category_sales(spark, src))


@query
def forecast_demand_category_arima(spark, src):
    return forecast.demand_category_arima(_category_sales(spark, src))


@query
def forecast_demand_arima_likelihood(spark, src):
    return arima.demand(_category_sales(spark, src))


@query
def anomaly_arima_residual(spark, src):
    return arima.residuals(_category_sales(spark, src))


@query
def delivery_quartiles_sketched(spark, src):
    """Quartiles of the single deliveries of each supplier and year, exact and from merged daily sketches."""
    return quartiles.check(frames.fact_deliveries(spark, src), F.year("date"))


@query
def forecast_lead_time(spark, src):
    return forecast.lead_time(frames.fact_deliveries(spark, src))


def _cash_days(spark, src):
    return forecast.cash_flow_days(staging.order_totals(spark, src), frames.fact_transactions(spark, src))


@query
def forecast_cash_flow(spark, src):
    return forecast.cash_flow(_cash_days(spark, src))


# --- quality and loads -----------------------------------------------------------------------


@query
def dq_orders(spark, src):
    return quality.orders(staging.order_lines(spark, src), staging.order_headers(spark, src))


@query
def dq_deliveries(spark, src):
    return quality.deliveries(staging.deliveries(spark, src))


@query
def dq_transactions(spark, src):
    return quality.transactions(staging.transactions(spark, src))


@query
def dq_duplicate_keys(spark, src):
    return quality.duplicate_keys(staging.order_lines(spark, src), ["order_id", "line_number"])


@query
def dq_referential_integrity(spark, src):
    return batch.referential_checks(
        staging.order_lines(spark, src),
        staging.order_headers(spark, src),
        staging.transactions(spark, src),
        staging.products(spark, src),
        staging.customers(spark, src),
        staging.suppliers(spark, src),
        staging.gl_accounts(spark, src),
    )


@query
def dq_range_checks(spark, src):
    return quality.ranges(staging.products(spark, src), staging.order_lines(spark, src), frames.fact_deliveries(spark, src))


@query
def dq_enum_domain(spark, src):
    return _enum_checks(spark, src)


def _enum_checks(spark, src):
    heads = staging.order_headers(spark, src)
    return quality.union(
        quality.count_failures(
            heads,
            "stg_orders",
            {
                "order_status_not_in_domain": ~F.col("order_status").isin(*schemas.ORDER_STATUS),
                "payment_status_not_in_domain": ~F.col("payment_status").isin(*schemas.PAYMENT_STATUS),
            },
        ),
        quality.enum_domain(staging.deliveries(spark, src), "stg_deliveries", "delivery_status", schemas.DELIVERY_STATUS),
        quality.enum_domain(staging.transactions(spark, src), "stg_transactions", "transaction_type", schemas.TRANSACTION_TYPE),
        quality.enum_domain(staging.customers(spark, src), "stg_customers", "segment", schemas.CUSTOMER_SEGMENT),
    )


@query
def dq_log(spark, src):
    found = quality.union(
        dq_orders(spark, src),
        quality.deliveries(staging.deliveries(spark, src)),
        quality.transactions(staging.transactions(spark, src)),
        quality.duplicate_summary(staging.order_lines(spark, src), "stg_orders", ["order_id", "line_number"]),
        dq_referential_integrity(spark, src),
        dq_range_checks(spark, src),
        _enum_checks(spark, src),
    )
    return quality.overall(found)


@query
def incremental_unprocessed(spark, src):
    """Orders still to load, when every order with a shipped line has been processed."""
    shipped = staging.order_lines(spark, src).filter("shipping_status = 'shipped'")
    done = loads.processed_keys(shipped, "order_id")
    left = loads.unprocessed(staging.order_headers(spark, src), done, "order_id")
    return left.select("order_id", "customer_id", F.to_date("order_date").alias("date"), "order_status")


@query
def incremental_fact_append(spark, src):
    """Deliveries loaded in two runs, the second of them twice, into one table. The cut is in the
    middle of a month, and every tenth of the earlier rows arrives late, with the second load."""
    path = session.work_dir(spark, "fact_deliveries")
    fact = frames.fact_deliveries(spark, src)
    on_time = (F.col("delivery_date_id") < 19980115) & (F.col("delivery_id") % 10 != 3)
    for part, load in ((on_time, "load-1"), (~on_time, "load-2"), (~on_time, "load-2")):
        loads.append_fact(fact.filter(part), path, "delivery_date_id", load)
    return loads.month_totals(warehouse.read(spark, path), "total_cost")


def _increments(spark, src):
    """The folder of two incremental runs. The first sees what lies before the middle of a month, but
    for every tenth order and delivery, and of another tenth of the orders the even lines; the second
    sees everything and loads the rest, late rows of old months and of split orders among it."""
    out = session.work_dir(spark, "increments")
    lines, deliveries = staging.order_codes(spark, src), staging.delivery_codes(spark, src)
    clicks, products = staging.sessions(spark, src), frames.dim_products(spark, src)
    early = (F.col("order_date") < "1997-01-15") & (F.col("order_id") % 10 != 3)
    early &= (F.col("order_id") % 10 != 7) | (F.col("line_number") % 2 == 1)
    arrived = (F.col("delivery_date") < "1997-01-15") & (F.col("delivery_id") % 10 != 3)
    batch.run_increment(spark, lines.filter(early), deliveries.filter(arrived), clicks, products, out, "1", coded=True)
    batch.run_increment(spark, lines, deliveries, clicks, products, out, "2", coded=True)
    return out


@query
def incremental_batch(spark, src):
    """The supply-chain mart after two incremental runs."""
    return warehouse.read(spark, f"{_increments(spark, src)}/supply_chain_daily_metrics").drop("month_id")


@query
def incremental_batch_shop(spark, src):
    """The shop's mart after the same runs."""
    return warehouse.read(spark, f"{_increments(spark, src)}/ecommerce_daily_metrics").drop("month_id", "customers_sketch")


@query
def load_audit_summary(spark, src):
    """The audit of a whole batch run from raw tables to marts."""
    out = session.work_dir(spark, "warehouse")
    batch.run_batch(spark, src, out)
    return loads.audit_summary(warehouse.read(spark, f"{out}/dw_load_audit"))


# --- events ----------------------------------------------------------------------------------


@query
def encode_order_events(spark, src):
    messages = events.encode(events.order_events(spark, src), "orders")
    return _plain_money(events.decoded_fields(messages, "orders"))


@query
def encode_batch_keyed(spark, src):
    """Transactions as one batch keyed by their account; a row without a key goes out unkeyed."""
    messages = events.encode_batch(staging.transactions(spark, src), schemas.TOPICS["transactions"], "gl_account_id")
    return events.messages_per_key(messages)


@query
def encode_batch_isolated(spark, src):
    """Transactions as one batch of messages of 2,000 bytes at most, some with a description far beyond
    that and some without a number for their rate: what was queued and what went to the dead letters,
    beside the count that the send reports."""
    rows = staging.transactions(spark, src).withColumn("exchange_rate", F.col("exchange_rate").cast("double"))
    number = F.col("transaction_id")
    rows = rows.withColumn("description", F.when(number % 89 == 0, F.repeat(F.lit("long "), 500)).otherwise(F.col("description")))
    rows = rows.withColumn("exchange_rate", F.when(number % 97 == 0, F.lit(float("nan"))).otherwise(F.col("exchange_rate")))
    outbox = session.work_dir(spark, "outbox")
    queued, _ = events.send_batch(events.sort_out(rows, schemas.TOPICS["transactions"], "gl_account_id", 2000), outbox)
    parts = [events.outbox_messages(spark, outbox, dead) for dead in (False, True)]
    counted = parts[0].unionByName(parts[1]).groupBy("topic", F.coalesce("reason", F.lit("queued")).alias("outcome"))
    return counted.agg(F.count(F.lit(1)).alias("messages")).withColumn("queued_in_all", F.lit(queued).cast("bigint"))


def _csv_round_trip(spark, mart, name):
    path = f"{session.work_dir(spark, 'csv')}/{name}"
    schema = schemas.MART_FILES[name]
    warehouse.write_csv(mart.select(*(field.split()[0] for field in schema.split(","))), path)
    return warehouse.read_csv(spark, path, schema)


@query
def csv_mart_roundtrip(spark, src):
    return _csv_round_trip(spark, frames.supply_chain(spark, src), "supply_chain_daily_metrics")


@query
def csv_ecommerce_roundtrip(spark, src):
    return _csv_round_trip(spark, frames.ecommerce(spark, src), "ecommerce_daily_metrics")


@query
def csv_financial_roundtrip(spark, src):
    return _csv_round_trip(spark, frames.financial(spark, src), "financial_daily_metrics")


# --- streams ---------------------------------------------------------------------------------

for _build in (
    queries.stream_multi_topic_route,
    queries.stream_decode_orders,
    queries.stream_quarantine,
    queries.stream_land_staging,
    queries.stream_tumbling_revenue,
    queries.stream_sliding_revenue,
    queries.stream_sessions,
    queries.stream_inventory_low,
    queries.stream_zscore,
    queries.stream_stock_alerts,
    queries.stream_dedup,
    queries.stream_click_to_purchase,
    queries.stream_enrich_customer,
    queries.stream_late_data,
):
    query(_build)


# --- reports ---------------------------------------------------------------------------------


@query
def top_products(spark, src):
    newest, days = staging.newest_order_day(spark, src), 30
    sales = staging.daily_product_sales(spark, src, start=F.date_sub(newest, days - 1))
    return reports.top_products(sales, frames.dim_products(spark, src), newest, days)


@query
def inventory_risk(spark, src):
    return reports.inventory_risk(frames.dim_products(spark, src))


@query
def cash_position(spark, src):
    return reports.cash_position(frames.fact_transactions(spark, src))


@query
def demand_trend(spark, src):
    return forecast.demand_trend(staging.daily_product_sales(spark, src))


@query
def reorder_forecast(spark, src):
    return forecast.reorder(staging.daily_product_sales(spark, src), frames.dim_products(spark, src))


@query
def forecast_accuracy(spark, src):
    return forecast.accuracy(_category_sales(spark, src), "category", "quantity")


@query
def anomaly_cash_flow(spark, src):
    series = anomaly.metric(_cash_days(spark, src), "financial", "net_cash_flow", "net_flow")
    return anomaly.scored_metrics(series, "iqr")


@query
def anomaly_lead_time(spark, src):
    return anomaly.scored_metrics(reports.lead_time_series(frames.fact_deliveries(spark, src)))


def _all_metrics(spark, src):
    return anomaly.scored_metrics(
        anomaly.all_metrics(
            frames.ecommerce(spark, src), frames.supply_chain(spark, src), frames.financial(spark, src)
        )
    )


@query
def anomaly_all_metrics(spark, src):
    return _all_metrics(spark, src)


@query
def anomaly_summary(spark, src):
    return anomaly.summary(_all_metrics(spark, src))


@query
def kpi_period_comparison(spark, src):
    return reports.kpi_period_comparison(
        frames.ecommerce(spark, src), frames.supply_chain(spark, src), frames.financial(spark, src)
    )


@query
def revenue_by_product(spark, src):
    return reports.revenue_by_product(staging.daily_product_sales(spark, src), frames.dim_products(spark, src))


@query
def delivery_performance(spark, src):
    return reports.delivery_performance(frames.fact_deliveries(spark, src))


@query
def cash_flow_daily(spark, src):
    return _cash_days(spark, src)


@query
def anomaly_seasonal(spark, src):
    return anomaly.seasonal(frames.ecommerce(spark, src))
