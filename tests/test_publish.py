"""Tables published in versions: no reader ever finds none."""

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import loads
from kpiloom.sources import warehouse


def values(df):
    return sorted(r["v"] for r in df.collect())


def table(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "v bigint")


def test_readers_keep_the_version_they_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    assert loads.publish_table(table(spark, 1, 2), path) == 2
    reading = warehouse.read(spark, path)
    assert loads.publish_table(table(spark, 3), path) == 1
    assert values(reading) == [1, 2] and values(warehouse.read(spark, path)) == [3]


def test_load_killed_before_its_commit_leaves_the_old_table(spark, tmp_path):
    """Part of the new version is written, then the driver is lost: readers, the view and the next load go on
    from the old one."""
    path = str(tmp_path / "t")
    warehouse.publish(table(spark, 1), path)
    warehouse.switch(spark, path, "published_killed")
    broken = table(spark, *range(8)).repartition(4).withColumn("v", F.when(F.col("v") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        warehouse.publish(broken, path)
    half = f"{path}/version-{3:010d}"  # another one, of which files are there but no commit
    table(spark, 5).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert values(warehouse.read(spark, path)) == [1] == values(spark.table("published_killed"))
    warehouse.publish(warehouse.read(spark, path).unionByName(table(spark, 2)), path)
    assert values(warehouse.read(spark, path)) == [1, 2]
    assert values(spark.table("published_killed")) == [1]
    warehouse.switch(spark, path, "published_killed")
    assert values(spark.table("published_killed")) == [1, 2]
    assert half in warehouse.expire(spark, path, 1)
    assert len(warehouse._folders(spark, path)) == 1 and values(spark.table("published_killed")) == [1, 2]
    spark.sql("DROP VIEW published_killed")


def test_old_versions_go_later(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        warehouse.publish(table(spark, n), path)
    assert len(warehouse.expire(spark, path, 2)) == 2
    assert [values(spark.read.parquet(v)) for v in warehouse.versions(spark, path)] == [[2], [3]]
    assert warehouse.expire(spark, path, 2) == [] and warehouse.expire(spark, str(tmp_path / "none")) == []
    with pytest.raises(ValueError):
        warehouse.expire(spark, path, 0)


def test_table_without_versions_is_read_as_it_is(spark, tmp_path):
    path = str(tmp_path / "plain")
    warehouse.overwrite(table(spark, 9), path)
    assert values(warehouse.read(spark, path)) == [9]


def test_touched_months_are_replaced_in_a_new_version(spark, tmp_path):
    path = str(tmp_path / "m")
    mart = lambda *rows: spark.createDataFrame(rows, "date_id int, v bigint")
    assert loads.replace_months(mart((20240101, 1), (20240102, 2), (20240201, 3)), path) == 3
    assert loads.replace_months(mart((20240102, 20), (20240301, 4)), path) == 2
    rows = sorted((r["date_id"], r["v"], r["month_id"]) for r in warehouse.read(spark, path).collect())
    assert rows == [(20240102, 20, 202401), (20240201, 3, 202402), (20240301, 4, 202403)]
    assert len(warehouse.versions(spark, path)) == 2


def test_marts_of_the_batch_group_no_orders(spark, src, tmp_path):
    """Lines are grouped once, by day, customer and status; what the marts read has no order in it."""
    from kpiloom.operators import facts, marts
    from kpiloom.plans import batch, frames
    from kpiloom.sources import staging

    lines = facts.orders(staging.orders(spark, src))
    path = str(tmp_path / "totals")
    warehouse.publish(batch.order_day_totals(lines), path)
    totals = warehouse.read(spark, path)
    assert "order_id" not in totals.columns
    mart = marts.ecommerce_daily(totals, staging.sessions(spark, src), frames.dim_products(spark, src))
    assert "order_id" not in mart._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, mart.collect()), key=repr) == sorted(map(tuple, frames.ecommerce(spark, src).collect()), key=repr)
