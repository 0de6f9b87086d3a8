"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import forecast
from kpiloom.plans import frames
from kpiloom.plans.catalog import QUERIES
from kpiloom.sources import staging

#: Queries that only build a plan: streams, loads and round trips run as they are built.
RUN_AT_ONCE = (
    "stream_", "incremental_", "csv_", "load_audit_summary", "dim_products_scd2_incremental", "encode_batch_isolated", "metrics_page_seek",
)
LAZY = sorted(name for name in QUERIES if not name.startswith(RUN_AT_ONCE))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, src, name):
    text = plan(QUERIES[name](spark, src))
    for bad in ("EvalPython", "ArrowEval", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_broadcasts_are_left_to_the_size_check(spark, src):
    """With automatic broadcasts off no broadcast is left: none is forced by a hint."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("kpi_rollup_category_day", "dim_customers_ltv", "dq_log", "alerts_active", "reorder_forecast"):
            assert "BroadcastHashJoin" not in plan(QUERIES[name](spark, src))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_range_reaches_the_scan(spark, src):
    text = plan(QUERIES["ecommerce_metrics_range"](spark, src))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in text
    assert "LessThan(o_orderdate,1999-01-01" in text


def test_other_ranges_reach_the_scan(spark, src):
    text = plan(QUERIES["supply_chain_metrics_range"](spark, src))
    assert "LessThan(l_shipdate,1999-01-01" in text
    text = plan(QUERIES["unified_kpis_range"](spark, src))
    assert "LessThan(l_shipdate,1999-02-15" in text and "LessThan(o_orderdate,1999-01-01" in text


def test_scan_reads_only_what_is_used(spark, src):
    text = plan(frames.supply_chain(spark, src))
    assert "l_tax" not in text and "l_discount" not in text


def test_last_rows_are_cut_before_the_shuffle(spark, src):
    for df in (
        forecast.lead_time(frames.fact_deliveries(spark, src)),
        forecast.demand_product(staging.daily_product_sales(spark, src)),
    ):
        assert "WindowGroupLimit" in plan(df)
    text = plan(forecast.lead_time(frames.fact_deliveries(spark, src)))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_lines_are_summed_before_they_meet_their_orders(spark, src):
    text = plan(staging.order_totals(spark, src))
    join = text.index("Join")
    assert "partial_sum" in text[join:] and "partial_sum" not in text[:join]


def test_one_hot_order_is_split(spark, tmp_path):
    """A third of all lines belong to one order: the join splits it over several tasks and
    keeps every row."""
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = 600_000
        lines = spark.range(0, rows, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_id"), F.md5(F.col("id").cast("string")).alias("text")
        )
        heads = spark.range(rows).select(F.col("id").alias("order_id"), (F.col("id") % 100).alias("day"))
        days = lines.join(heads, "order_id").groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.max("text"))
        counts = {r["day"]: r["n"] for r in days.collect()}
        assert sum(counts.values()) == rows and counts[7] > rows / 3
        assert "skew=true" in days._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_messages_are_parsed_once(spark, src):
    plan = QUERIES["encode_order_events"](spark, src)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_lines_outside_a_range_meet_no_shuffle(spark, src, monkeypatch):
    """Few orders: their ids are broadcast and other lines dropped at the scan. More than the bound: as
    without a range, and with the same rows."""
    import datetime

    days = datetime.date(1997, 1, 1), datetime.date(1997, 1, 31)
    few = staging.order_totals(spark, src, *days)
    text = plan(few)
    assert text.index("Exchange hashpartitioning(order_id") < text.index("LeftSemi") < text.index("l_orderkey")
    rows = sorted(map(tuple, few.collect()))
    monkeypatch.setattr(staging, "BROADCAST_ORDERS", 3)
    many = staging.order_totals(spark, src, *days)
    assert "LeftSemi" not in plan(many) and sorted(map(tuple, many.collect())) == rows and rows
