"""The nightly batch: quality log, dimensions, facts, marts and audit, in that order."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.expressions import cents, date_id
from kpiloom.operators import dimensions, facts, loads, marts, quality
from kpiloom.sources import staging, warehouse

PROCESS, SOURCE = "etl_batch_processing", "kafka_staging"


def referential_checks(
    order_lines: DataFrame,
    order_headers: DataFrame,
    transactions: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    suppliers: DataFrame,
    gl_accounts: DataFrame,
) -> DataFrame:
    """Orphans among the foreign keys of the facts."""
    return quality.union(
        quality.missing_parents(order_lines, "order_id", order_headers, "order_id", "stg_orders"),
        quality.missing_parents(order_lines, "product_id", products, "product_id", "stg_orders"),
        quality.missing_parents(order_lines, "supplier_id", suppliers, "supplier_id", "stg_orders"),
        quality.missing_parents(order_headers, "customer_id", customers, "customer_id", "stg_orders"),
        quality.missing_parents(transactions, "gl_account_id", gl_accounts, "gl_account_id", "stg_transactions"),
    )


def staging_checks(
    order_lines: DataFrame, order_headers: DataFrame, deliveries: DataFrame, transactions: DataFrame
) -> DataFrame:
    """The checks that staging must pass before it is loaded."""
    return quality.union(
        quality.orders(order_lines, order_headers), quality.deliveries(deliveries), quality.transactions(transactions)
    )


class _Run:
    """Writes tables under one folder and keeps audit rows for each: one before a step begins and
    one when it has ended, so a step that a lost driver leaves behind stands there as begun."""

    def __init__(self, spark: SparkSession, out: str, load_id: str = "all"):
        # Letters in front: folder names that look like numbers would be read back as numbers.
        self.spark, self.out, self.load_id = spark, out, f"load-{load_id}"
        self.run_id, self.rows = f"run-{uuid.uuid4().hex}", []

    def begin(self, *tables: str) -> None:
        """Note steps that are about to run; steps of one group share a file."""
        now = datetime.now(timezone.utc)
        rows = [(PROCESS, SOURCE, table, None, "IN_PROGRESS", now, None, None) for table in tables]
        warehouse.append(self.spark.createDataFrame(rows, loads.AUDIT).coalesce(1), f"{self.out}/dw_load_audit")

    def _audited(self, table: str, write) -> DataFrame:
        path = f"{self.out}/{table}"
        start = datetime.now(timezone.utc)
        try:
            count = write(path)
        except Exception as failure:
            self.rows.append((PROCESS, SOURCE, table, None, "FAILED", start, datetime.now(timezone.utc), str(failure)))
            raise
        self.rows.append((PROCESS, SOURCE, table, count, "SUCCESS", start, datetime.now(timezone.utc), None))
        return warehouse.read(self.spark, path)

    def table(self, name: str, df: DataFrame) -> DataFrame:
        return self._audited(name, lambda path: loads.publish_table(facts.with_load_times(df), path))

    def derived(self, name: str, df: DataFrame) -> DataFrame:
        """A table that only later steps read: published like others, not part of the audit."""
        path = f"{self.out}/{name}"
        warehouse.publish(df, path)
        return warehouse.read(self.spark, path)

    def fact(self, name: str, df: DataFrame, day: Column | str, derive: warehouse.Derive = lambda rows: rows) -> DataFrame:
        """``derive`` makes the fact's rows of those of ``df`` when these are with their months."""
        timed = lambda rows: facts.with_load_times(derive(rows))
        return self._audited(name, lambda path: loads.append_fact(df, path, day, self.load_id, timed))

    def log(self, checks: DataFrame) -> DataFrame:
        """Add the checks of this run to the quality log; only these are returned."""
        name = "data_quality_log"
        rows = checks.withColumn("run_timestamp", F.current_timestamp())
        write = lambda path: loads.overwrite_table(facts.with_load_times(rows), f"{path}/run_id={self.run_id}")
        return self._audited(name, write).filter(F.col("run_id") == self.run_id)

    def together(self, *steps) -> list[DataFrame]:
        """Steps that do not need each other, as concurrent jobs of the one session."""
        with ThreadPoolExecutor(len(steps)) as pool:
            return [done.result() for done in [pool.submit(inheritable_thread_target(self.spark)(step)) for step in steps]]

    def close(self) -> None:
        if self.rows:
            audit = self.spark.createDataFrame(self.rows, loads.AUDIT)
            warehouse.append(audit.coalesce(1), f"{self.out}/dw_load_audit")


AMOUNTS = {"order_cents": "order_amount", "total_cents": "total_amount", "cost_cents": "cost_amount"}


def _with_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", F.to_date(F.col("order_date_id").cast("string"), "yyyyMMdd"))


def order_day_totals(fact_orders: DataFrame) -> DataFrame:
    """Stored order lines summed per day, customer and status: all that the dimensions and marts ask of
    them. Grouped once and stored, it spares each of its readers a shuffle of all orders."""
    sums = (F.sum(cents(amount)).alias(name) for name, amount in AMOUNTS.items())
    return _with_date(
        fact_orders.groupBy("order_date_id", "customer_id", "order_status").agg(F.count(F.lit(1)).alias("order_count"), *sums)
    )


def order_line_totals(fact_orders: DataFrame) -> DataFrame:
    """Stored order lines as totals of one line each, for a single reader that groups them itself."""
    amounts = (cents(amount).alias(name) for name, amount in AMOUNTS.items())
    return _with_date(
        fact_orders.select("order_date_id", "customer_id", F.lit(1).cast("bigint").alias("order_count"), *amounts)
    )


def run_batch(spark: SparkSession, src: str, out: str, strict: bool = True) -> None:
    """Validate staging, then load a whole warehouse into ``out``. Running it again gives the
    same tables, and adds to the quality log and the audit. With ``strict`` a failed check stops the
    batch before anything is loaded.

    Each table is written once and counted by its own write; later steps read the stored
    tables, so a lost executor costs one step and never the chain before it.
    """
    run = _Run(spark, out)
    try:
        _validate(run, spark, src, strict)
        _load(run, spark, src)
    finally:
        run.close()


def _validate(run: _Run, spark: SparkSession, src: str, strict: bool) -> None:
    checks = staging_checks(
        staging.order_lines(spark, src),
        staging.order_headers(spark, src),
        staging.deliveries(spark, src),
        staging.transactions(spark, src),
    )
    run.begin("data_quality_log")
    logged = run.log(checks)
    if strict:
        quality.raise_on_failure(logged)


def _load(run: _Run, spark: SparkSession, src: str) -> None:
    days = staging.raw(spark, src, "orders").select(F.to_date("o_orderdate").alias("date"))
    run.begin(
        "fact_orders", "fact_deliveries", "fact_transactions", "fact_budget_actuals", "dim_products", "dim_gl_accounts",
        "dim_dates",
    )
    orders, deliveries, ledger, budget, products, _, _ = run.together(
        lambda: run.fact(
            "fact_orders", staging.order_codes(spark, src), date_id("order_date"),
            lambda codes: facts.orders(staging.orders_from(codes, "month_id"), "month_id"),
        ),
        lambda: run.fact(
            "fact_deliveries", staging.delivery_codes(spark, src), date_id("delivery_date"),
            lambda codes: facts.deliveries(staging.deliveries_from(codes, "month_id"), "month_id"),
        ),
        lambda: run.fact(
            "fact_transactions", staging.ledger_codes(spark, src), date_id("transaction_date"),
            lambda codes: facts.transactions(staging.transactions_from(codes, "month_id"), "month_id"),
        ),
        lambda: run.fact(
            "fact_budget_actuals",
            facts.budget_actuals(staging.budgets(spark, src), staging.actuals(spark, src)),
            "date_id",
        ),
        lambda: run.table("dim_products", dimensions.products(staging.products(spark, src))),
        lambda: run.table("dim_gl_accounts", dimensions.gl_accounts(staging.gl_accounts(spark, src))),
        lambda: run.table("dim_dates", dimensions.dates_spanning(days)),
    )
    totals = run.derived("order_day_totals", order_day_totals(orders))
    run.begin(
        "dim_customers", "dim_suppliers", "ecommerce_daily_metrics", "supply_chain_daily_metrics",
        "financial_daily_metrics", "unified_kpi_metrics",
    )
    staged_suppliers = staging.suppliers(spark, src)
    run.together(
        lambda: run.table("dim_customers", dimensions.customers(staging.customers(spark, src), totals)),
        lambda: run.table("dim_suppliers", dimensions.suppliers(staged_suppliers, deliveries)),
        lambda: run.table(
            "ecommerce_daily_metrics", marts.ecommerce_daily(totals, staging.sessions(spark, src), products, sketches=True)
        ),
        lambda: run.table("supply_chain_daily_metrics", marts.supply_chain_daily(deliveries)),
        lambda: run.table("financial_daily_metrics", marts.financial_daily(ledger, budget, totals)),
        lambda: run.table(
            "unified_kpi_metrics", marts.unified_daily(totals, deliveries, staged_suppliers, products)
        ),
    )


def run_increment(
    spark: SparkSession, lines: DataFrame, deliveries: DataFrame, sessions: DataFrame, products: DataFrame, out: str,
    load_id: str, coded: bool = False,
) -> None:
    """Load what has arrived and no finished load has taken: facts, then the shop and supply-chain
    marts of the months they touch, then the marks of what was loaded. Lines of one order may arrive
    with different loads; the stored orders keep ``line_number``, which tells them apart.

    ``lines`` and ``deliveries`` are staged order lines (as ``staging.orders`` gives them) and
    deliveries, all that is there so far; ``coded``, they are ``staging.order_codes`` and
    ``staging.delivery_codes``, which are worked out when they are with their months, and move a third of
    the bytes to get there. A load that broke off is run again under its id: it
    replaces its own rows, and marks are set last. Marts are worked out anew from the stored facts
    of their months, so late rows of an old month count there.
    """
    run = _Run(spark, out, load_id)
    try:
        run.begin("fact_orders", "fact_deliveries")
        orders, delivered = run.together(
            lambda: run.fact(
                "fact_orders", _unmarked(run, lines, "orders"), date_id("order_date"),
                lambda rows: facts.orders(
                    staging.orders_from(rows, "month_id") if coded else rows, "line_number", "month_id"
                ),
            ),
            lambda: run.fact(
                "fact_deliveries", _unmarked(run, deliveries, "deliveries"), date_id("delivery_date"),
                lambda rows: facts.deliveries(staging.deliveries_from(rows, "month_id") if coded else rows, "month_id"),
            ),
        )
        run.begin("ecommerce_daily_metrics", "supply_chain_daily_metrics")
        shop = marts.ecommerce_daily(order_line_totals(_touched(orders, run.load_id)), sessions, products, sketches=True)
        sold, brought = _months(orders, run.load_id), _months(delivered, run.load_id)
        shop = shop.withColumn("month", F.floor(F.col("date_id") / 100).cast("int"))
        shop = shop.join(F.broadcast(sold), F.col("month") == F.col("month_id"), "left_semi").drop("month")
        chain = marts.supply_chain_daily(_touched(delivered, run.load_id))
        run.together(
            lambda: run._audited("ecommerce_daily_metrics", lambda path: loads.replace_months(shop, path, sold)),
            lambda: run._audited("supply_chain_daily_metrics", lambda path: loads.replace_months(chain, path, brought)),
        )
        for name, fact in (("orders", orders), ("deliveries", delivered)):
            # A key that comes twice is marked twice: whoever asks for marks tells them apart.
            own = fact.filter(F.col("load_id") == run.load_id).select(*MARKS[name])
            warehouse.overwrite(own, f"{out}/processed_{name}/load_id={run.load_id}")
    finally:
        run.close()


#: What a load marks as done. An order has several lines, and an id may be delivered on several days.
MARKS = {"orders": ("order_id", "line_number"), "deliveries": ("delivery_id", "delivery_date")}


def _unmarked(run: _Run, staged: DataFrame, name: str) -> DataFrame:
    """Staged rows that no finished load but this one has marked."""
    path = f"{run.out}/processed_{name}"
    if not warehouse.exists(run.spark, path):
        return staged
    marked = warehouse.read(run.spark, path).filter(F.col("load_id") != run.load_id)
    if name == "orders":
        return loads.unprocessed_lines(staged, marked, *MARKS[name])
    return loads.unprocessed(staged, marked, *MARKS[name])


def _touched(fact: DataFrame, load_id: str) -> DataFrame:
    """The stored rows, of all loads, of the months that one load has rows in. There are as many months
    as the calendar has: rows are picked where they are read, and do not move."""
    return fact.join(F.broadcast(_months(fact, load_id)), "month_id", "left_semi")


def _months(fact: DataFrame, load_id: str) -> DataFrame:
    return fact.filter(F.col("load_id") == load_id).select("month_id").distinct()
