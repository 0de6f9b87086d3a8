"""Alerts while a stream runs, against plain Python and whatever the cut into batches."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from kpiloom.sources import staging
from kpiloom.streaming import alerts, queries, runner

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
LINES = "product_id bigint, product_name string, reorder_point int"


def at(minutes):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)


def in_files(spark, src, path, files):
    """The events cut into files by time, the oldest first."""
    events = staging.raw(spark, src, "events").withColumn("cut", F.ntile(files).over(queries.alerts.Window.orderBy("ts", "event_id"))).persist()
    for cut in range(1, files + 1):
        events.filter(F.col("cut") == cut).drop("cut").coalesce(1).write.mode("append").parquet(f"{path}/events.parquet")
    events.unpersist()
    staging.raw(spark, src, "part").write.parquet(f"{path}/part.parquet")


@pytest.mark.parametrize("build", [queries.stream_zscore, queries.stream_stock_alerts])
def test_many_files_give_what_one_gives(spark, src, tmp_path, build):
    in_files(spark, src, str(tmp_path), 4)
    whole = sorted(map(tuple, build(spark, src).collect()), key=repr)
    assert sorted(map(tuple, build(spark, str(tmp_path), 1).collect()), key=repr) == whole
    assert len(whole) > 5


def test_hours_are_scored_once_against_a_stored_baseline(spark, src, tmp_path):
    in_files(spark, src, str(tmp_path), 3)
    run, baseline = queries.hourly_scores(spark, str(tmp_path), 1)
    hours = run.table.select("date").collect()
    assert len({r["date"] for r in hours}) == len(hours) and len([b for b in run.batches if b.rows]) == 3
    assert run.table.select("batch_id").distinct().count() > 1
    assert baseline.count() == 30
    newest = sorted(r["date"] for r in hours)[-30:]
    assert sorted(r["date"] for r in baseline.collect()) == newest
    assert "Window" not in run.table._jdf.queryExecution().optimizedPlan().toString()


def test_batch_that_runs_again_reads_what_the_one_before_it_left(spark, tmp_path):
    """The driver is lost after a batch has written all but is not committed."""
    landing, home = str(tmp_path / "in"), str(tmp_path / "home")
    schema = "v bigint"
    tries = []

    def step(batch, before):
        total = before.select("v").unionByName(batch.select("v")).agg(F.coalesce(F.sum("v"), F.lit(0)).alias("v"))
        if len(tries) == 1:
            tries.append("lost")
            total.write.mode("overwrite").parquet(f"{home}/carried/1")
            raise RuntimeError("lost")
        tries.append("ran")
        return batch, total

    for value in (1, 10):
        spark.createDataFrame([(value,)], schema).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        for _ in range(2):
            try:
                run, left = runner.run_carrying(spark, stream, "t", step, schema, home=home)
                break
            except Exception:
                pass
    assert "lost" in tries
    assert left.first()["v"] == 11 and sorted(r["v"] for r in run.table.collect()) == [1, 10]


def expected(events, lines):
    """Alerts by a walk over each product's events."""
    out, last = [], {}
    for event_id, product, level, seen in sorted(events, key=lambda e: (e[3], e[0])):
        if level is None or product is None:
            continue
        before = last.get(product)
        previous = before[0] if before and seen - before[1] <= datetime.timedelta(days=7) else None
        if product in lines and level < lines[product] and (previous is None or previous >= lines[product]):
            out.append((product, event_id, previous, level, None if previous is None else level - previous))
        last[product] = (level, seen)
    return sorted(out, key=repr)


def stepped(spark, batches, lines):
    """Alerts over some batches, and what is remembered at the end."""
    table = spark.createDataFrame([(p, f"p{p}", line) for p, line in lines.items()], LINES)
    known, out = spark.createDataFrame([], alerts.LEVELS), []
    for rows in batches:
        df = spark.createDataFrame(rows, "event_id bigint, product_id bigint, stock_level int, seen timestamp")
        found, left = alerts.stock_step(df, table, known)
        out += [(r["product_id"], r["event_id"], r["previous_level"], r["stock_level"], r["change_quantity"]) for r in found.collect()]
        known = spark.createDataFrame(left.collect(), alerts.LEVELS)
    return sorted(out, key=repr), {r["product_id"]: r["stock_level"] for r in known.collect()}


def test_one_alert_per_crossing(spark):
    """Down, further down, up, down again; then silence for eight days while it is low."""
    rows = [(1, 1, 50, at(0)), (2, 1, 9, at(10)), (3, 1, 5, at(20)), (4, 1, 10, at(70)), (5, 1, 3, at(130)), (6, 1, 2, at(8 * 1440 + 140))]
    want = [(1, 2, 50, 9, -41), (1, 5, 10, 3, -7), (1, 6, None, 2, None)]
    for batches in ([rows], [rows[:2], rows[2:4], rows[4:]], [[r] for r in rows]):
        found, known = stepped(spark, batches, {1: 10})
        assert found == want and known == {1: 2}


def test_random_events_in_random_batches(spark):
    draw = random.Random(3)
    lines = {p: 10 for p in range(4)}
    rows = [(i, draw.randrange(5), draw.choice([None, *range(20)]), at(draw.randrange(3000) if i % 9 else 40000 + i)) for i in range(300)]
    rows.sort(key=lambda e: (e[3], e[0]))
    cuts = sorted(draw.sample(range(1, 300), 3))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 300])]
    assert stepped(spark, batches, lines)[0] == expected(rows, lines)


def test_silent_products_are_forgotten_and_old_levels_change_nothing(spark):
    first = [(1, 1, 5, at(0)), (2, 2, 50, at(0))]
    second = [(3, 2, 40, at(20 * 1440))]
    late = [(4, 2, 1, at(30)), (5, 2, 8, at(20 * 1440 + 5))]
    found, known = stepped(spark, [first, second, late], {1: 10, 2: 10})
    assert found == [(1, 1, None, 5, None), (2, 5, 40, 8, -32)]
    assert known == {2: 8}


def test_hot_product_is_put_in_order_by_hours(spark):
    rows = spark.range(60_000).select(
        F.col("id").alias("event_id"), F.lit(1).cast("bigint").alias("product_id"),
        F.when(F.col("id") % 1000 == 999, 3).otherwise(20).cast("int").alias("stock_level"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 6).alias("seen"),
    )
    found, left = alerts.stock_step(rows, spark.createDataFrame([(1, "p", 10)], LINES), spark.createDataFrame([], alerts.LEVELS))
    assert found.count() == 60 and left.first()["event_id"] == 59_999
    windows = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert len(windows) == 2 and all(", hour" in x or "[hour" in x for x in windows)


def test_no_events(spark, tmp_path):
    spark.createDataFrame([], EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    staging_tables = "/root/testdata/sf0.001/part.parquet"
    spark.read.parquet(staging_tables).write.parquet(str(tmp_path / "part.parquet"))
    assert queries.stream_zscore(spark, str(tmp_path)).count() == 0
    assert queries.stream_stock_alerts(spark, str(tmp_path)).count() == 0
