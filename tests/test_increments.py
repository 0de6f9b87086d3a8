"""Loads that move few bytes: codes dealt to their months, marks by bit, months known beforehand."""

import datetime

from pyspark.sql import functions as F

from kpiloom.operators import facts, loads, marts
from kpiloom.plans import batch
from kpiloom.sources import staging, warehouse


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lines_are_told_apart_by_bit_and_beyond(spark):
    """Numbers on both sides of the bits, nulls and repeated lines, against the anti join."""
    numbers = [0, 1, 1, 31, 32, 62, 63, 64, 1000, -1, None]
    rows = [(k, n, i) for k in (1, 2, 3, None) for i, n in enumerate(numbers)]
    staged = spark.createDataFrame(rows, "order_id bigint, line_number int, x int")
    marked = [(1, n) for n in (1, 32, 62, 64, None)] + [(2, 63), (2, -1), (2, 0), (2, 0), (None, 1), (9, 1)]
    done = spark.createDataFrame(marked, "order_id bigint, line_number int")
    got = loads.unprocessed_lines(staged, done, "order_id", "line_number")
    want = loads.unprocessed(staged, done, "order_id", "line_number")
    assert sorted(map(repr, got.select("order_id", "line_number", "x").collect())) == sorted(
        map(repr, want.select("order_id", "line_number", "x").collect())
    )
    assert got.count() == len(rows) - 5 - 3


def test_facts_are_worked_out_behind_the_shuffle(spark, src, tmp_path):
    """What is dealt to months are codes: no name of a status and no decimal passes the exchange."""
    codes = staging.order_codes(spark, src).hint("rebalance", "order_date")
    text = facts.orders(staging.orders_from(codes))._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.index("RebalancePartitions"):]
    assert "delivered" not in below and "decimal" not in below
    path = str(tmp_path / "fact")
    derive = lambda rows: facts.orders(staging.orders_from(rows, "month_id"), "month_id")
    day = F.year("order_date") * 10000 + F.month("order_date") * 100
    count = loads.append_fact(staging.order_codes(spark, src), path, day, "load-1", derive)
    direct = facts.orders(staging.orders(spark, src))
    stored = warehouse.read(spark, path).select(direct.columns)
    assert count == direct.count()
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, direct.collect()))


def test_coded_increments_equal_staged_ones(spark, src, tmp_path):
    clicks, products = staging.sessions(spark, src), staging.products(spark, src)
    for out, lines, deliveries, coded in (
        ("staged", staging.orders(spark, src), staging.deliveries(spark, src), False),
        ("coded", staging.order_codes(spark, src), staging.delivery_codes(spark, src), True),
    ):
        early, arrived = lines.filter("line_number <= 2"), deliveries.filter("delivery_id % 3 = 0")
        batch.run_increment(spark, early, arrived, clicks, products, f"{tmp_path}/{out}", "1", coded=coded)
        batch.run_increment(spark, lines, deliveries, clicks, products, f"{tmp_path}/{out}", "2", coded=coded)
    for name in ("fact_orders", "fact_deliveries", "ecommerce_daily_metrics", "supply_chain_daily_metrics"):
        one, other = (warehouse.read(spark, f"{tmp_path}/{x}/{name}").drop("dw_created_at", "dw_updated_at") for x in ("staged", "coded"))
        assert one.count() and not one.exceptAll(other.select(one.columns)).count() and one.count() == other.count()


def test_touched_months_are_picked_where_they_are_read(spark, tmp_path):
    rows = spark.createDataFrame([(1, 20240105, "load-1"), (2, 20240210, "load-2"), (3, 20240201, "load-1")], "id int, day int, load string")
    path = str(tmp_path / "fact")
    for load in ("load-1", "load-2"):
        loads.append_fact(rows.filter(F.col("load") == load), path, "day", load)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        touched = batch._touched(warehouse.read(spark, path), "load-2")
        assert sorted(r["id"] for r in touched.collect()) == [2, 3]
        assert "SortMergeJoin" not in touched._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_single_lines_make_the_same_mart(spark, src):
    day = datetime.date(1997, 1, 1)
    fact = facts.orders(staging.orders(spark, src).filter(F.col("order_date") < F.lit(day)))
    clicks, products = staging.sessions(spark, src), staging.products(spark, src)
    one, other = (marts.ecommerce_daily(totals(fact), clicks, products) for totals in (batch.order_line_totals, batch.order_day_totals))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
    assert shuffles(one) < shuffles(other)


def test_whole_batch_deals_codes_to_months(spark, src, tmp_path, monkeypatch):
    dealt, keep = {}, loads.append_fact
    monkeypatch.setattr(loads, "append_fact", lambda df, path, *more: (dealt.update({path.split("/")[-1]: df.columns}), keep(df, path, *more))[1])
    batch.run_batch(spark, src, str(tmp_path))
    assert not {"order_status", "total_amount", "delivery_status", "unit_cost", "description"} & {c for n in dealt for c in dealt[n]}
    direct = facts.transactions(staging.transactions(spark, src))
    stored = warehouse.read(spark, f"{tmp_path}/fact_transactions").select(direct.columns)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, direct.collect()))
