"""Distinct customers of any range from the sketches of the daily mart."""

import datetime

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import marts, serving

SESSIONS = "date date, has_cart int, has_order int"
PRODUCTS = "product_id bigint, current_stock_level int, cost decimal(10,2)"


def mart_of(spark, totals):
    """Orders as (day of 2024, customer): a mart with sketches."""
    totals = totals.select(
        F.date_add(F.lit(datetime.date(2024, 1, 1)), F.col("day").cast("int")).alias("date"),
        "customer_id",
        *(F.lit(1).cast("bigint").alias(name) for name in ("order_count", "order_cents", "total_cents", "cost_cents")),
    )
    products = spark.createDataFrame([], PRODUCTS)
    return totals, marts.ecommerce_daily(totals, spark.createDataFrame([], SESSIONS), products, sketches=True)


def test_far_beyond_the_exact_size(spark):
    """300,000 customers, each on three days of one quarter, half of them in the next one too."""
    orders = spark.range(1_200_000).select(
        F.when(F.col("id") < 900_000, F.col("id") % 300_000).otherwise(F.col("id") % 150_000).alias("customer_id"),
        F.when(F.col("id") < 900_000, (F.col("id") + F.floor(F.col("id") / 300_000)) % 80).otherwise(91 + F.col("id") % 80).alias("day"),
    )
    totals, mart = mart_of(spark, orders)
    quarter = F.to_date(F.date_trunc("quarter", "date"))
    rows = marts.distinct_customers_check(totals, mart, quarter).orderBy("date").collect()
    exact = orders.filter("day >= 91").select("customer_id").distinct().count()
    assert [(r["customers"], r["returning"]) for r in rows] == [(300_000, 0), (exact, exact)]
    assert all(r["customers_within_bound"] and r["returning_within_bound"] for r in rows)
    sketched = marts.distinct_customers(mart, quarter).orderBy("period").collect()
    assert abs(sketched[0]["customers"] - 300_000) < 0.032 * 300_000
    days = mart.agg(F.sum("total_customers")).first()[0]
    assert days > 900_000  # customer days are another thing
    assert mart.agg(F.max(F.octet_length("customers_sketch"))).first()[0] < 140_000


@pytest.mark.parametrize("granularity, want", [("weekly", [("2024-01-01", 3), ("2024-01-08", 1)]), ("monthly", [("2024-01-01", 3)])])
def test_periods_count_customers_once(spark, granularity, want):
    """Null customers are no customer; those of several days count once."""
    orders = spark.createDataFrame([(0, 1), (0, 2), (1, 1), (2, 1), (2, None), (3, 3), (7, 1), (7, None)], "day int, customer_id bigint")
    _, mart = mart_of(spark, orders)
    rows = serving.ecommerce_metrics(mart, "2024-01-01", "2024-01-31", granularity).collect()
    assert sorted((str(r["date"]), r["total_customers"]) for r in rows) == want
    assert sum(r["total_orders"] for r in rows) == 8


def test_no_orders(spark):
    totals, mart = mart_of(spark, spark.createDataFrame([], "day int, customer_id bigint"))
    assert marts.distinct_customers_check(totals, mart, F.col("date")).count() == 0
    assert serving.ecommerce_metrics(mart, "2024-01-01", "2024-01-31", "weekly").count() == 0
    funnel = spark.createDataFrame([(datetime.date(2024, 1, 2), 1, 0)], SESSIONS)
    mart = marts.ecommerce_daily(totals, funnel, spark.createDataFrame([], PRODUCTS), sketches=True)
    rows = serving.ecommerce_metrics(mart, "2024-01-01", "2024-01-31", "weekly").collect()
    assert [(str(r["date"]), r["total_customers"]) for r in rows] == [("2024-01-01", 0)]


def test_sketches_are_left_out_where_they_are_not_asked_for(spark, src):
    from kpiloom.plans import frames

    mart = frames.ecommerce(spark, src)
    assert "customers_sketch" not in mart.columns
    assert "theta" not in mart._jdf.queryExecution().optimizedPlan().toString()


def test_large_periods_are_counted_not_estimated(spark):
    """50,000 customers on three days each, within two weeks: far beyond what a sketch keeps."""
    orders = spark.range(150_000).select((F.col("id") % 50_000).alias("customer_id"), F.floor(F.col("id") / 50_000).alias("third"), "id")
    orders = orders.select("customer_id", (F.col("third") * 4 + F.col("id") % 3).cast("int").alias("day"))
    totals, mart = mart_of(spark, orders)
    for granularity, unit in (("weekly", "week"), ("monthly", "month")):
        rows = serving.ecommerce_metrics(mart, "2024-01-01", "2024-01-31", granularity, totals).collect()
        exact = totals.groupBy(F.to_date(F.date_trunc(unit, "date")).alias("date")).agg(F.countDistinct("customer_id").alias("n")).collect()
        assert {r["date"]: r["total_customers"] for r in rows} == {r["date"]: r["n"] for r in exact}
        assert max(r["n"] for r in exact) == 50_000
    with pytest.raises(Exception, match="give the orders"):
        serving.ecommerce_metrics(mart, "2024-01-01", "2024-01-31", "monthly").collect()


def test_large_tables_are_counted_by_the_queries(spark, src, tmp_path):
    """20,000 customers of one month, two of whom come in two weeks of it, and an order of no customer."""
    from kpiloom.plans.catalog import QUERIES
    from kpiloom.sources.schemas import RAW

    for table in ("part", "events"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{src}/{table}.parquet")
    given = {
        "orders": {
            "o_orderkey": F.col("id"),
            "o_custkey": F.when(F.col("id") < 20_002, F.col("id") % 20_000),
            "o_orderdate": F.when(F.col("id") < 20_000, F.lit("1997-06-03")).otherwise(F.lit("1997-06-10")),
            "o_orderstatus": F.lit("F"),
        },
        "lineitem": {"l_orderkey": F.col("id"), "l_partkey": F.lit(1), "l_quantity": F.lit(1), "l_extendedprice": F.lit(10.0), "l_discount": F.lit(0.0)},
    }
    for table, columns in given.items():
        fields = spark.createDataFrame([], RAW[table]).schema.fields
        rows = spark.range(20_003).select(*(columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))
        rows.write.parquet(str(tmp_path / f"{table}.parquet"))
    weeks, months = (
        {str(r["date"]): (r["total_orders"], r["total_customers"]) for r in QUERIES[f"ecommerce_metrics_{name}"](spark, str(tmp_path)).collect()}
        for name in ("weekly", "monthly")
    )
    assert weeks == {"1997-06-02": (20_000, 20_000), "1997-06-09": (3, 2)}
    assert months == {"1997-06-01": (20_003, 20_000)}
