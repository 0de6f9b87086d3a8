"""The streaming queries. Each runs over all that has arrived and returns its result table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.expressions import rounded
from kpiloom.session import work_dir
from kpiloom.sources import staging
from kpiloom.sources.schemas import TOPICS
from kpiloom.streaming import alerts, events
from kpiloom.streaming.runner import (
    Run,
    append_to_table,
    batches_to_table,
    event_stream,
    land,
    latest,
    message_stream,
    run_append,
    run_batches,
    run_carrying,
)

VALUE = "decimal(12,2)"


def _text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


# --- transport -------------------------------------------------------------------------------


def stream_decode_orders(spark: SparkSession, src: str) -> DataFrame:
    """Order events through a topic and back; revenue and orders per day and status."""
    landing = work_dir(spark, "orders-topic")
    land(events.encode(events.order_events(spark, src), "orders"), landing)
    decoded = events.decode(message_stream(spark, landing), "orders").filter(~F.col("is_corrupt"))
    table = append_to_table(
        spark, decoded.select("event.order_id", "event.order_date", "event.order_status", "event.total_amount"), "orders"
    )
    return table.groupBy(F.to_date("order_date").alias("date"), "order_status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").cast("double").alias("revenue")
    )


def _stock_messages(spark: SparkSession, src: str) -> DataFrame:
    """Stock levels from the click stream (product = user, level = 3k); those of error events are
    cut off before the closing brace."""
    level = F.get_json_object("props", "$.k").cast("int") * 3
    body = F.format_string('{"product_id": %d, "stock_level": %d', F.col("user_id"), level)
    return staging.raw(spark, src, "events").select(
        F.col("event_id").cast("string").alias("key"),
        F.concat(body, F.when(F.col("event_type") == "error", "").otherwise("}")).alias("value"),
        F.lit(TOPICS["inventory"]).alias("topic"),
    )


def stream_quarantine(spark: SparkSession, src: str) -> DataFrame:
    """Stock messages, with those that do not parse set apart with their text."""
    landing = work_dir(spark, "inventory-topic")
    land(_stock_messages(spark, src), landing)
    decoded = events.decode(message_stream(spark, landing), "inventory")
    sorted_out = decoded.select(
        "key",
        "is_corrupt",
        F.when(~F.col("is_corrupt"), F.col("event.stock_level")).alias("stock_level"),
        F.when(F.col("is_corrupt"), F.col("value")).alias("raw_value"),
    )
    return append_to_table(spark, sorted_out, "quarantine", partition_by=["is_corrupt"]).select(
        "key", "is_corrupt", "stock_level", "raw_value"
    )


def stream_land_staging(spark: SparkSession, src: str) -> DataFrame:
    """Ledger events landed in staging by micro-batches of a few files; totals per day and type."""
    landing = work_dir(spark, "transactions-topic")
    land(events.encode(events.transaction_events(spark, src), "transactions"), landing)
    decoded = events.decode(message_stream(spark, landing, files_per_trigger=64), "transactions")
    table = batches_to_table(
        spark, decoded, "stg_transactions", transform=lambda batch: batch.filter(~F.col("is_corrupt")).select("event.*").drop(events.CORRUPT)
    )
    return table.groupBy(F.to_date("transaction_date").alias("date"), "transaction_type").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("debit_amount").cast("double").alias("debit"),
        F.sum("credit_amount").cast("double").alias("credit"),
    )


def _land_topic(spark: SparkSession, src: str, kind: str, path: str) -> None:
    land(events.encode(events.EVENT_MAKERS[kind](spark, src), kind), path)


def stream_multi_topic_route(spark: SparkSession, src: str) -> DataFrame:
    """All nine topics in one stream: each message is parsed by its topic's schema and lands in its
    topic's partition, in a single pass. Customers and suppliers carry no amount."""
    landing = work_dir(spark, "topics")
    amounts = {
        "orders": "total_amount",
        "deliveries": "total_cost",
        "transactions": "net_amount",
        "budgets": "budget_amount",
        "actuals": "actual_amount",
        "inventory": "stock_level",
        "purchase_orders": "total_cost",
        "customers": None,
        "suppliers": None,
    }
    # Each topic has a folder of its own: its job commits without the others.
    lands = [partial(_land_topic, spark, src, kind, f"{landing}/{kind}") for kind in amounts]
    with ThreadPoolExecutor(len(lands)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in lands]:
            done.result()

    def amount(kind: str) -> Column:
        return events.parse(F.col("value"), kind, amounts[kind])[amounts[kind]].cast("decimal(15,2)")

    routed = F.coalesce(*(F.when(F.col("topic") == TOPICS[kind], amount(kind)) for kind in amounts if amounts[kind]))
    table = append_to_table(
        spark, message_stream(spark, f"{landing}/*").select("topic", "key", routed.alias("amount")), "routed", partition_by=["topic"]
    )
    return table.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.countDistinct("key").alias("keys"),
        F.sum("amount").cast("double").alias("amount"),
    )


# --- event-time windows ----------------------------------------------------------------------


def _windowed_revenue(spark: SparkSession, src: str, label: str, span: str, slide: str | None = None) -> DataFrame:
    purchases = event_stream(spark, src).filter("event_type = 'purchase'").withWatermark("ts", "1 hour")
    window = F.window("ts", span, slide) if slide else F.window("ts", span)
    sums = purchases.groupBy(window.alias("w")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("value").cast(VALUE)).alias("revenue")
    )
    flat = sums.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "orders", "revenue")
    return latest(batches_to_table(spark, flat, label, mode="update"), ["start", "end"])


def _window_rows(windows: DataFrame) -> DataFrame:
    return windows.select(
        _text(F.col("start")).alias("window_start"),
        _text(F.col("end")).alias("window_end"),
        "orders",
        F.col("revenue").cast("double").alias("revenue"),
    )


def stream_tumbling_revenue(spark: SparkSession, src: str) -> DataFrame:
    return _window_rows(_windowed_revenue(spark, src, "tumbling", "1 hour"))


def stream_sliding_revenue(spark: SparkSession, src: str) -> DataFrame:
    return _window_rows(_windowed_revenue(spark, src, "sliding", "1 hour", "15 minutes"))


def hourly_scores(spark: SparkSession, src: str, files_per_trigger: int | None = None) -> tuple[Run, DataFrame]:
    """Hours of purchases, each scored when the watermark (1 hour) closes it against a stored baseline
    of the 30 before it: the run, whose table holds an hour once, and the baseline that is left."""
    purchases = event_stream(spark, src, files_per_trigger).filter("event_type = 'purchase'").withWatermark("ts", "1 hour")
    sums = purchases.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.sum(F.col("value").cast(VALUE)).alias("revenue"))
    hours = sums.select(F.col("w.start").alias("date"), F.col("revenue").cast("double").alias("value"))
    return run_carrying(spark, hours, "hourly", alerts.score_hours, alerts.BASELINE)


def stream_zscore(spark: SparkSession, src: str, files_per_trigger: int | None = None) -> DataFrame:
    """Hourly revenue of the stream, each hour scored against the 30 before it while the stream runs. The
    hours still open at its end are read from its state and scored as they stand, marked as open."""
    run, baseline = hourly_scores(spark, src, files_per_trigger)
    scored = run.table.select("date", "value", "mean", "z", "is_anomaly", F.lit(False).alias("is_open"))
    for operator in run.operators("stateStoreSave"):
        held = run.state(operator)
        open_hours = held.select(
            F.col("key.window.start").alias("date"), F.when(~F.col("value.isEmpty"), F.col("value.sum")).cast("double").alias("value")
        )
        preview, _ = alerts.score_hours(open_hours, baseline)
        scored = scored.unionByName(preview.select("date", "value", "mean", "z", "is_anomaly", F.lit(True).alias("is_open")))
    return scored.select(
        _text(F.col("date")).alias("hour"),
        F.col("value").alias("revenue"),
        rounded(F.col("mean"), 4).alias("expected_value"),
        rounded(F.col("z"), 6).alias("z_score"),
        "is_anomaly",
        "is_open",
    )


def stream_sessions(spark: SparkSession, src: str) -> DataFrame:
    """User sessions with a gap of 30 minutes: those that the watermark (1 hour) has closed, and,
    marked as open, those that may still grow. The open ones are read from the stream's state."""
    events = event_stream(spark, src).withWatermark("ts", "1 hour")
    found = events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("s"))
    found = found.agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast(VALUE)).alias("total"))
    found = found.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events", "total")
    run = run_append(spark, found, "sessions")
    table = run.table.withColumn("is_open", F.lit(False))
    for operator in run.operators("sessionWindowStateStoreSaveExec"):
        held = run.state(operator).select("value.*")
        table = table.unionByName(
            held.select(
                "user_id",
                F.col("session_window.start").alias("start"),
                F.col("session_window.end").alias("end"),
                F.col("count").alias("events"),
                F.when(~F.col("isEmpty"), F.col("sum")).alias("total"),
                F.lit(True).alias("is_open"),
            )
        )
    return table.select(
        "user_id",
        _text(F.col("start")).alias("session_start"),
        _text(F.col("end")).alias("session_end"),
        "events",
        F.col("total").cast("double").alias("total_value"),
        "is_open",
    )


# --- state -----------------------------------------------------------------------------------


def stream_inventory_low(spark: SparkSession, src: str) -> DataFrame:
    """Products whose latest stock level lies below their reorder point. The raw data has no stock
    events; they are taken from the click stream (product = user, level = 3k)."""
    level = F.get_json_object("props", "$.k").cast("int") * 3
    newest = F.max_by(level, F.struct("ts", "event_id")).alias("stock_level")
    levels = event_stream(spark, src).groupBy(F.col("user_id").alias("product_id")).agg(newest, F.max("ts").alias("seen"))
    current = latest(batches_to_table(spark, levels, "inventory", mode="update"), ["product_id"])
    line = staging.products(spark, src).select("product_id", "product_name", "reorder_point")
    return (
        current.join(line, "product_id")
        .filter("stock_level < reorder_point")
        .select("product_id", "product_name", "stock_level", "reorder_point", _text(F.col("seen")).alias("last_seen"))
    )


def stream_stock_alerts(spark: SparkSession, src: str, files_per_trigger: int | None = None) -> DataFrame:
    """An alert each time a product's stock falls below its reorder line, with the level before it. The
    levels are those of ``stream_inventory_low``."""
    levels = event_stream(spark, src, files_per_trigger).select(
        F.col("user_id").alias("product_id"),
        (F.get_json_object("props", "$.k").cast("int") * 3).alias("stock_level"),
        F.col("ts").alias("seen"),
        "event_id",
    )
    lines = staging.products(spark, src).select("product_id", "product_name", "reorder_point")
    run, _ = run_carrying(spark, levels, "stock-alerts", lambda batch, known: alerts.stock_step(batch, lines, known), alerts.LEVELS)
    return run.table.select(
        "product_id", "product_name", "event_id", _text(F.col("seen")).alias("at"), "previous_level", "stock_level", "change_quantity", "reorder_point"
    )


def stream_dedup(spark: SparkSession, src: str) -> DataFrame:
    """Every event delivered twice, kept once.

    Copies carry one event time, so an id is grouped within its hour: unlike a stream's
    ``dropDuplicates``, a grouping folds copies before the shuffle, and one event that was sent
    very often does not end up whole in one task. The state of an hour lives for a day. A copy in
    a later batch repeats its row, which merges with the first.
    """
    twice = event_stream(spark, src).union(event_stream(spark, src))
    once = (
        twice.withWatermark("ts", "1 day")
        .groupBy("event_id", F.window("ts", "1 hour").alias("w"))
        .agg(F.min(F.struct("ts", "user_id", "event_type", "value")).alias("event"))
        .select("event_id", "event")
    )
    table = latest(batches_to_table(spark, once, "dedup", mode="update"), ["event_id"])
    return table.select("event_id", "event.user_id", "event.event_type", "event.value")


def stream_click_to_purchase(spark: SparkSession, src: str) -> DataFrame:
    """Minutes in which a user bought, where the same user clicked in that minute or the 60 before.

    Both sides are first reduced to user and minute by the stream itself. The semi join then
    holds at most one row per user and minute and emits a purchase minute once, so a hot user
    never yields all pairs of clicks and purchases. The stream gives a minute when the watermark
    has closed it. Minutes still open are read from its state, marked as such, together with the clicks
    that the state holds: those of open minutes, and those of closed minutes that the join keeps.
    """
    events = event_stream(spark, src).withWatermark("ts", "10 minutes")

    def per_minute(kind: str) -> DataFrame:
        return events.filter(F.col("event_type") == kind).groupBy("user_id", F.window("ts", "1 minute").alias("w"))

    bought = (
        per_minute("purchase")
        .agg(F.count(F.lit(1)).alias("purchases"), F.sum(F.col("value").cast(VALUE)).alias("amount"))
        .select("user_id", F.window_time("w").alias("bought_at"), F.col("w.start").alias("minute"), "purchases", "amount")
    )
    clicked = per_minute("click").agg(F.count(F.lit(1)).alias("clicks")).select(
        F.col("user_id").alias("clicker"), F.window_time("w").alias("clicked_at"), "clicks"
    )
    # Every row has one event at least. Naming both counts keeps the join above both sums: below them, its
    # state would hold every single purchase.
    near = F.expr(
        "user_id = clicker and clicked_at <= bought_at and clicked_at >= bought_at - interval 60 minutes and purchases + clicks >= 2"
    )
    run = run_append(spark, bought.join(clicked, near, "left_semi"), "click-to-purchase")
    columns = ["user_id", "minute", "purchases", "amount"]
    table = run.table.select(*columns).withColumn("is_open", F.lit(False))
    joins = run.operators("symmetricHashJoin")
    if joins:
        sums = [run.state(operator) for operator in run.operators("stateStoreSave")]
        last = F.col("key.window.end") - F.expr("interval 1 microsecond")
        open_bought, open_clicked = sorted(sums, key=lambda held: "sum" not in held.schema["value"].dataType.names)
        open_bought = open_bought.select(
            "key.user_id",
            last.alias("bought_at"),
            F.col("key.window.start").alias("minute"),
            F.col("value.count").alias("purchases"),
            F.when(~F.col("value.isEmpty"), F.col("value.sum")).alias("amount"),
        )
        clicks = open_clicked.select(F.col("key.user_id").alias("clicker"), last.alias("clicked_at"), F.col("value.count").alias("clicks"))
        clicks = clicks.unionByName(run.state(joins[0], joinSide="right").select("value.*"))
        found = open_bought.join(clicks, near, "left_semi")
        table = table.unionByName(found.select(*columns, F.lit(True).alias("is_open")))
    return table.select(
        "user_id",
        _text(F.col("minute")).alias("minute"),
        "purchases",
        F.col("amount").cast("double").alias("amount"),
        "is_open",
    )


def stream_enrich_customer(spark: SparkSession, src: str) -> DataFrame:
    """Events with the customer's segment and country; value per day, segment and country.

    The join is made inside each micro-batch, where it is an ordinary batch join: its size
    decides between broadcast and shuffle, and a hot user is split.
    """
    customers = staging.customers(spark, src).select(F.col("customer_id").alias("user_id"), "segment", "country")
    table = batches_to_table(
        spark,
        event_stream(spark, src).select("event_id", "ts", "user_id", "value"),
        "enriched",
        transform=lambda batch: batch.join(customers, "user_id", "left"),
    )
    return table.groupBy(F.to_date("ts").alias("date"), "segment", "country").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast(VALUE)).cast("double").alias("total_value")
    )


def late_events(spark: SparkSession, src: str) -> tuple[Run, DataFrame, DataFrame]:
    """Events counted by hour with a watermark of one hour when purchases arrive after everything else:
    the second run, the events that it and the first counted, and the late ones as they arrived.

    The stream runs twice from one checkpoint. In the second run the watermark stands an hour before
    the newest event of the first, so purchases in closed hours are late and refused. Grouping by event
    as well as hour makes the engine's count of refused rows a count of events, and folds an event that
    was sent twice. Each run takes its part as one batch, so the part's late events are those of hours
    that were closed at the watermark the engine reports for that batch; they land in a table of their own.
    """
    home = work_dir(spark, "late")
    landing = f"{home}/landing"
    arrived = staging.raw(spark, src, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
    on_time = F.col("event_type") != "purchase"
    for part in (arrived.filter(on_time), arrived.filter(~on_time)):
        land(part, landing)
        counted = (
            spark.readStream.schema(arrived.schema)
            .parquet(landing)
            .withWatermark("ts", "1 hour")
            .groupBy(F.window("ts", "1 hour").alias("w"), "event_id")
            .agg(F.count(F.lit(1)).alias("copies"))
            .select(F.col("w.start").alias("start"), "event_id", "copies")
        )
        run = run_batches(spark, counted, "late", mode="update", home=home)
        fed = [b for b in run.batches if b.rows]
        if len(fed) > 1:
            raise RuntimeError("a part must be one batch")
        closed_at = F.lit(fed[0].watermark if fed else None).cast("timestamp")
        refused = part.filter(F.window("ts", "1 hour").end <= closed_at)
        refused.write.mode("append").parquet(f"{home}/refused")
    return run, latest(run.table, ["start", "event_id"]), spark.read.schema(arrived.schema).parquet(f"{home}/refused")


def stream_late_data(spark: SparkSession, src: str) -> DataFrame:
    """Per hour the events counted in time and those that came too late (``late_events``), beside the
    number of late events that the engine itself reports for the whole run."""
    run, counted, refused = late_events(spark, src)
    in_time = counted.groupBy("start").agg(F.sum("copies").alias("counted"), F.lit(0).cast("bigint").alias("late"))
    late = refused.groupBy(F.window("ts", "1 hour").start.alias("start"))
    late = late.agg(F.lit(0).cast("bigint").alias("counted"), F.count(F.lit(1)).alias("late"))
    hours = in_time.unionByName(late).groupBy("start").agg(F.sum("counted").alias("counted"), F.sum("late").alias("late"))
    return hours.select(
        _text(F.col("start")).alias("hour"), "counted", "late", F.lit(run.dropped).cast("bigint").alias("dropped_by_engine")
    )
