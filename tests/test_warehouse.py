"""Dimensions, facts, marts, quality checks, loads and the batch run."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpiloom import session
from kpiloom.functions import checks
from kpiloom.functions.expressions import date_id, divided, hundredths, money, percent, rounded
from kpiloom.operators import dimensions, facts, loads, marts, quality, serving
from kpiloom.plans import batch, frames
from kpiloom.sources import schemas, staging, warehouse

D = datetime.date


def test_calendar(spark):
    days = {r["date_id"]: r for r in dimensions.dates(spark).collect()}
    assert len(days) == 4018 and min(days) == 20200101 and max(days) == 20301231
    monday = days[20241230]
    assert (monday["year"], monday["week"], monday["iso_year"], monday["day_of_week"]) == (2024, 1, 2025, 1)
    assert (monday["day_name"], monday["month_name"], monday["is_weekend"]) == ("Monday", "December", False)
    assert days[20240203]["is_weekend"] and days[20240204]["is_weekend"]


def test_versions_join_equal_neighbours(spark):
    rows = [(1, D(2024, 1, 1), 5), (1, D(2024, 1, 4), 5), (1, D(2024, 1, 9), 6), (1, D(2024, 2, 1), 5), (2, D(2024, 1, 2), 7)]
    got = dimensions.versions(spark.createDataFrame(rows, "id bigint, valid_from date, cost int"), "id", "cost").collect()
    assert sorted((r["id"], r["version"], r["valid_from"], r["valid_to"], r["cost"], r["is_current"]) for r in got) == [
        (1, 1, D(2024, 1, 1), D(2024, 1, 8), 5, False),
        (1, 2, D(2024, 1, 9), D(2024, 1, 31), 6, False),
        (1, 3, D(2024, 2, 1), None, 5, True),
        (2, 1, D(2024, 1, 2), None, 7, True),
    ]


def test_zero_divisors_give_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 8.0)], "a double, b double").select(percent(F.col("a"), F.col("b")).alias("p"))
    assert [r["p"] for r in df.collect()] == [None, 12.5]


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(50.005,), (1.005,), (-1.005,), (None,)], "x double").select(rounded(F.col("x"), 2).alias("y"))
    assert [r["y"] for r in df.collect()] == [50.01, 1.01, -1.01, None]


def test_whole_number_division(spark):
    rows = [(5, 2), (-5, 2), (7, 3), (-7, 3), (1, 0)]
    df = spark.createDataFrame(rows, "a bigint, b int").select(divided(F.col("a"), F.col("b")).alias("q"))
    assert [r["q"] for r in df.collect()] == [3, -3, 2, -2, None]
    prices = spark.createDataFrame([(0.29,), (1.1,), (-0.07,), (99999.99,)], "p double").select(money(hundredths("p")).alias("m"))
    assert [str(r["m"]) for r in prices.collect()] == ["0.29", "1.10", "-0.07", "99999.99"]


def test_date_id(spark):
    df = spark.createDataFrame([(D(2024, 1, 5),), (None,)], "d date").select(date_id("d").alias("k"))
    assert [r["k"] for r in df.collect()] == [20240105, None]


def test_budget_sides(spark):
    b = spark.createDataFrame(
        [(1, "a", D(2024, 1, 1), 100, "Monthly", 1), (2, "a", D(2024, 2, 1), 0, "Monthly", 1)],
        "budget_id bigint, gl_account_id string, budget_date date, budget_amount int, budget_type string, budget_version int",
    )
    a = spark.createDataFrame(
        [("a", D(2024, 1, 1), 130), ("a", D(2024, 2, 1), 5), ("a", D(2024, 3, 1), 9)],
        "gl_account_id string, actual_date date, actual_amount int",
    )
    got = {r["date"].month: (r["variance_amount"], r["variance_pct"]) for r in facts.budget_actuals(b, a).collect()}
    assert got == {1: (Decimal("30.00"), 30.0), 2: (Decimal("5.00"), None), 3: (None, None)}


def test_delivery_dates(spark, src):
    fact = frames.fact_deliveries(spark, src)
    assert fact.filter("lead_time_days < 1 or lead_time_days > 45").count() == 0
    assert fact.filter("is_on_time <> (lead_time_days <= 30)").count() == 0


def test_customers_without_orders_are_kept(spark):
    staged = spark.createDataFrame([(1, "n", "s", "c", "r"), (2, "n", "s", "c", "r")], "customer_id bigint, customer_name string, segment string, country string, region string")
    totals = spark.createDataFrame([(1, 250), (1, 50), (9, 5)], "customer_id bigint, total_cents bigint")
    got = {r["customer_id"]: r["lifetime_value"] for r in dimensions.customers(staged, totals).collect()}
    assert got == {1: 3.0, 2: 0.0}


def test_funnel(spark):
    day = D(2024, 1, 1)
    rows = [(day, 1, 1), (day, 0, 1), (day, 0, 1), (day, 0, 0)]
    row = marts.funnel_daily(spark.createDataFrame(rows, "date date, has_order int, has_cart int")).first()
    assert (row["conversion_rate"], row["cart_abandonment_rate"]) == (25.0, 66.67)


def test_wider_periods_weigh_by_orders(spark):
    rows = [(D(2024, 1, 1), 1, 1, 100.0, 2.0, 0.0), (D(2024, 1, 2), 9, 3, 90.0, None, 0.0)]
    mart = spark.createDataFrame(
        rows, "date date, total_orders bigint, total_customers bigint, total_revenue double, conversion_rate double, inventory_turnover double"
    )
    mart = mart.withColumn("customers_sketch", F.lit(None).cast("binary"))
    row = serving.ecommerce_metrics(mart, "2024-01-01", "2024-01-31", "weekly").first()
    assert (row["date"], row["total_orders"], row["average_order_value"], row["conversion_rate"]) == (D(2024, 1, 1), 10, 19.0, 2.0)


def test_unknown_supplier_gives_no_row(spark, src):
    assert serving.supplier_performance(frames.dim_suppliers(spark, src), -1).count() == 0
    assert serving.supplier_performance(frames.dim_suppliers(spark, src), 3).count() == 1


def test_summary_fills_missing_domains(spark):
    e = spark.createDataFrame([(D(2024, 1, 1), 1, 9.0, 9.0, None), (D(2024, 1, 2), 0, 0.0, 0.0, 1.0)], "date date, total_orders bigint, total_revenue double, average_order_value double, conversion_rate double")
    s = spark.createDataFrame([], "date date, on_time_delivery_pct double, average_lead_time_days double")
    f = spark.createDataFrame([], "date date, net_income double, gross_margin_pct double")
    assert tuple(serving.kpi_summary(e, s, f).first()) == (D(2024, 1, 1), 9.0, 9.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_budget_range_defaults_to_thirty_days(spark):
    rows = [("a", D(2024, 3, 31), 1, 1, 0, 0.0), ("a", D(2024, 3, 1), 1, 1, 0, 0.0), ("b", D(2024, 2, 29), 1, 1, 0, 0.0)]
    fact = spark.createDataFrame(rows, "gl_account_id string, date date, budget_amount int, actual_amount int, variance_amount int, variance_pct double")
    assert [r["date"].day for r in serving.budget_vs_actual(fact).collect()] == [1, 31]
    assert serving.budget_vs_actual(fact, "b").count() == 0


def test_parameter_limits():
    for call in (
        lambda: checks.date_range("2024-02-01", "2024-01-31"),
        lambda: checks.days(0),
        lambda: checks.days(366),
        lambda: checks.horizon(400),
        lambda: checks.lookback(6),
        lambda: checks.limit(1001),
        lambda: checks.offset(-1),
        lambda: checks.one_of("granularity", "hourly", checks.GRANULARITIES),
    ):
        with pytest.raises(ValueError):
            call()
    assert checks.date_range("2024-01-01", "2024-01-01") == (D(2024, 1, 1), D(2024, 1, 1))


def test_bad_rows_are_counted(spark):
    lines = spark.createDataFrame([(None, 1), (1, -5), (2, 5)], "order_id bigint, total_amount int")
    heads = spark.createDataFrame([(1, None), (2, 7)], "order_id bigint, customer_id bigint")
    found = quality.orders(lines, heads)
    assert {r["check_name"]: (r["status"], r["failed_count"]) for r in found.collect()} == {
        "null_order_id": ("FAILED", 1),
        "negative_amounts": ("FAILED", 1),
        "null_customer_id": ("FAILED", 1),
    }
    with pytest.raises(ValueError, match="negative_amounts=1"):
        quality.raise_on_failure(found)
    empty = quality.orders(lines.filter("false"), heads.filter("false"))
    assert {r["status"] for r in empty.collect()} == {"PASSED"}
    quality.raise_on_failure(empty)


def test_orphans_and_duplicates(spark):
    child = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k bigint")
    parent = spark.createDataFrame([(2,)], "p bigint")
    row = quality.missing_parents(child, "k", parent, "p", "t").first()
    assert (row["record_count"], row["failed_count"], row["status"]) == (4, 3, "FAILED")
    assert [(r["k"], r["occurrences"]) for r in quality.duplicate_keys(child, ["k"]).collect()] == [(1, 3)]
    assert quality.duplicate_summary(child, "t", ["k"]).first()["failed_count"] == 2


def test_unknown_enum_members(spark):
    df = spark.createDataFrame([("paid",), ("lost",), (None,)], "s string")
    assert quality.enum_domain(df, "t", "s", schemas.PAYMENT_STATUS).first()["failed_count"] == 1


def test_loads_of_one_month_add_up(spark, src, tmp_path):
    path = str(tmp_path / "fact")
    march = frames.fact_deliveries(spark, src).filter("delivery_date_id between 19970301 and 19970331")
    first, second = march.filter("delivery_date_id <= 19970315"), march.filter("delivery_date_id > 19970315")
    counts = [loads.append_fact(part, path, "delivery_date_id", load) for part, load in ((first, "a"), (second, "b"), (second, "b"))]
    assert counts[1] == counts[2] and counts[0] > 0 < counts[1]
    stored = warehouse.read(spark, path)
    assert stored.count() == stored.select("delivery_id").distinct().count() == counts[0] + counts[1] == march.count()


def test_reload_replaces_its_own_rows_only(spark, src, tmp_path):
    path = str(tmp_path / "fact")
    fact = frames.fact_deliveries(spark, src)
    loads.append_fact(fact.filter("delivery_id % 2 = 0"), path, "delivery_date_id", "even")
    loads.append_fact(fact.filter("delivery_id % 2 = 1"), path, "delivery_date_id", "odd")
    corrected = fact.filter("delivery_id % 2 = 1 and delivery_date_id < 19970101")
    loads.append_fact(corrected, path, "delivery_date_id", "odd")
    stored = warehouse.read(spark, path)
    assert stored.count() == fact.filter("delivery_id % 2 = 0").count() + corrected.count()
    assert "PartitionFilters: [isnotnull(month_id" in stored.filter("month_id = 199703")._jdf.queryExecution().executedPlan().toString()


def test_unprocessed_rows(spark):
    staged = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "order_id bigint, x string")
    done = loads.processed_keys(staged.filter("order_id < 3"), "order_id")
    assert [r["x"] for r in loads.unprocessed(staged, done, "order_id").collect()] == ["d"]


def test_batch_twice_gives_the_same_tables(spark, src, tmp_path):
    out = str(tmp_path / "wh")
    read = lambda name: warehouse.read(spark, f"{out}/{name}").drop("dw_created_at", "dw_updated_at")
    names = ("fact_orders", "dim_customers", "ecommerce_daily_metrics", "unified_kpi_metrics")
    batch.run_batch(spark, src, out)
    first = {name: sorted(map(tuple, read(name).collect()), key=repr) for name in names}
    batch.run_batch(spark, src, out)
    assert {name: sorted(map(tuple, read(name).collect()), key=repr) for name in names} == first
    direct = sorted(map(tuple, frames.ecommerce(spark, src, sketches=True).collect()), key=repr)
    assert first["ecommerce_daily_metrics"] == direct
    audit = loads.audit_summary(warehouse.read(spark, f"{out}/dw_load_audit"))
    assert {(r["status"], r["attempts"]) for r in audit.collect()} == {("SUCCESS", 2)} and audit.count() == 14
    begun = warehouse.read(spark, f"{out}/dw_load_audit").filter("status = 'IN_PROGRESS'")
    assert begun.count() == 2 * 14
    logged = warehouse.read(spark, f"{out}/data_quality_log").groupBy("run_id").count().collect()
    assert len(logged) == 2 and len({r["count"] for r in logged}) == 1


def test_increments_equal_one_full_run(spark, src, tmp_path):
    lines, deliveries = staging.orders(spark, src), staging.deliveries(spark, src)
    clicks, products = staging.sessions(spark, src), frames.dim_products(spark, src)
    early = lines.filter("order_date < '1997-01-15' and order_id % 10 != 3")
    arrived = deliveries.filter("delivery_date < '1997-01-15' and delivery_id % 10 != 3")
    out, whole = str(tmp_path / "parts"), str(tmp_path / "whole")
    batch.run_increment(spark, early, arrived, clicks, products, out, "1")
    batch.run_increment(spark, lines, deliveries, clicks, products, out, "2")
    batch.run_increment(spark, lines, deliveries, clicks, products, out, "2")  # run again: nothing changes
    batch.run_increment(spark, lines, deliveries, clicks, products, whole, "1")
    for name in ("ecommerce_daily_metrics", "supply_chain_daily_metrics"):
        one, other = (sorted(map(tuple, warehouse.read(spark, f"{x}/{name}").collect()), key=repr) for x in (out, whole))
        assert one == other and one
    audit = warehouse.read(spark, f"{out}/dw_load_audit").filter("table_name = 'fact_orders' and status = 'SUCCESS'")
    counts = sorted(r["record_count"] for r in audit.collect())
    assert counts == sorted([early.count(), *[lines.count() - early.count()] * 2])


def test_lines_of_one_order_may_arrive_apart(spark, src, tmp_path):
    lines, deliveries = staging.orders(spark, src), staging.deliveries(spark, src)
    clicks, products = staging.sessions(spark, src), frames.dim_products(spark, src)
    out = str(tmp_path)
    early = lines.filter("line_number % 2 = 1 or order_id % 10 != 7")
    batch.run_increment(spark, early, deliveries, clicks, products, out, "1")
    batch.run_increment(spark, lines, deliveries, clicks, products, out, "2")
    assert warehouse.read(spark, f"{out}/fact_orders").count() == lines.count() > early.count()
    mart = warehouse.read(spark, f"{out}/ecommerce_daily_metrics").drop("month_id")
    direct = frames.ecommerce(spark, src)
    assert sorted(map(tuple, mart.select(direct.columns).collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_begun_step_stays_in_the_audit(spark, tmp_path):
    batch._Run(spark, str(tmp_path)).begin("fact_orders")  # and the driver is lost
    row = warehouse.read(spark, f"{tmp_path}/dw_load_audit").first()
    assert (row["table_name"], row["status"], row["end_time"]) == ("fact_orders", "IN_PROGRESS", None)


def test_failed_step_is_audited(spark, tmp_path):
    run = batch._Run(spark, str(tmp_path))
    broken = spark.range(3).select(F.raise_error(F.lit("broken input")).alias("x"))
    with pytest.raises(Exception, match="broken input"):
        run.table("t", broken)
    run.close()
    row = warehouse.read(spark, f"{tmp_path}/dw_load_audit").first()
    assert (row["table_name"], row["status"]) == ("t", "FAILED") and "broken input" in row["error_message"]


def test_sizes_follow_the_input():
    widths = [int(session.sized_for(n)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) for n in (10**9, 10**13, 10**14)]
    assert widths[0] == 200 and 7_000 < widths[1] < 8_000 and 74_000 < widths[2] < 75_000


class Cluster:
    """A session as far as the work folder is concerned."""

    def __init__(self, folder):
        self.conf = {"spark.sql.warehouse.dir": "hdfs://shared/warehouse"}
        if folder:
            self.conf["spark.checkpoint.dir"] = folder


def test_work_folder_comes_from_the_session(spark):
    first, second = (session.work_dir(Cluster("hdfs://shared/check/"), "x") for _ in range(2))
    assert first.startswith("hdfs://shared/check/x-") and first != second
    assert session.work_dir(Cluster(None), "x").startswith("hdfs://shared/warehouse/x-")
    assert session.work_dir(spark, "x").split("/")[-1].startswith("x-")


def test_csv_marts(spark, src, tmp_path):
    for name, mart in (("ecommerce_daily_metrics", frames.ecommerce), ("financial_daily_metrics", frames.financial)):
        schema = schemas.MART_FILES[name]
        columns = [c.strip().split(" ")[0] for c in schema.split(",")]
        df = mart(spark, src).select(*columns)
        warehouse.write_csv(df, str(tmp_path / name))
        assert sorted(warehouse.read_csv(spark, str(tmp_path / name), schema).collect()) == sorted(df.collect())


def test_staged_range_equals_a_late_filter(spark, src):
    cut = staging.order_totals(spark, src, D(1997, 1, 1), D(1997, 1, 31))
    late = staging.order_totals(spark, src).filter("date between '1997-01-01' and '1997-01-31'")
    assert sorted(cut.collect()) == sorted(late.collect())
