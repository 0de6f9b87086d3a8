"""Message encoding and the streaming helpers."""

import datetime
import json
from decimal import Decimal

from pyspark.sql import functions as F

from kpiloom import session
from kpiloom.sources import staging
from kpiloom.sources.schemas import EVENTS, TOPIC_KEYS, TOPICS
from kpiloom.streaming import events, queries, runner


def messages(spark, *values, topic="ecommerce.orders"):
    return spark.createDataFrame([(str(i), v, topic) for i, v in enumerate(values)], "key string, value string, topic string")


ORDER = {
    "order_id": 12345,
    "customer_id": 1001,
    "product_id": 501,
    "order_date": "2024-01-15T10:30:00",
    "quantity": 3,
    "list_price": "49.99",
    "order_amount": "149.97",
    "total_amount": "162.47",
    "cost_amount": "89.97",
}


def test_money_as_text_and_as_number(spark):
    numbers = {**ORDER, "list_price": 49.99, "order_amount": 149.97, "total_amount": 162.47, "cost_amount": 89.97}
    rows = events.decode(messages(spark, json.dumps(ORDER), json.dumps(numbers)), "orders").collect()
    for row in rows:
        assert not row["is_corrupt"]
        assert row["event"]["total_amount"] == Decimal("162.47") and row["event"]["quantity"] == 3
        assert row["event"]["order_date"] == datetime.datetime(2024, 1, 15, 10, 30)
        assert row["event"]["supplier_id"] is None


def test_delivery_event(spark):
    value = json.dumps({"delivery_id": 9001, "po_id": 3001, "quantity_ordered": 100, "quantity_delivered": 98, "unit_cost": "30.00", "total_cost": "2940.00"})
    event = events.decode(messages(spark, value), "deliveries").first()["event"]
    assert (event["delivery_id"], event["quantity_delivered"], event["total_cost"]) == (9001, 98, Decimal("2940.00"))


def test_broken_messages_do_not_stop_the_rest(spark):
    rows = events.decode(messages(spark, json.dumps(ORDER), "{not json", '{"order_id": "x"}', None), "orders").collect()
    assert [r["is_corrupt"] for r in sorted(rows, key=lambda r: r["key"])] == [False, True, True, True]
    assert [r["order_id"] for r in events.decoded_fields(messages(spark, json.dumps(ORDER), "{"), "orders").collect()] == [12345]


def test_encoding(spark):
    df = spark.createDataFrame([(7, Decimal("1.50"), datetime.datetime(2024, 1, 15, 10))], "order_id bigint, total_amount decimal(12,2), order_date timestamp")
    row = events.encode(df, "orders").first()
    assert (row["key"], row["topic"]) == ("7", "ecommerce.orders")
    value = json.loads(row["value"])
    assert value["total_amount"] == 1.5 and value["order_date"].startswith("2024-01-15T10:00:00")


def test_unkeyed_batch(spark):
    rows = events.encode_batch(spark.createDataFrame([("a",), (None,)], "k string"), "t", "k").collect()
    assert [r["key"] for r in rows] == ["a", None]
    assert events.encode_batch(spark.createDataFrame([("a",)], "k string"), "t").first()["key"] is None


def test_every_topic_has_a_key_and_a_schema():
    assert len(TOPICS) == 9 and TOPICS.keys() == TOPIC_KEYS.keys() == EVENTS.keys()
    assert all(f"{TOPIC_KEYS[kind]} " in EVENTS[kind] for kind in TOPICS)


def test_events_of_every_kind_survive_the_topic(spark, src):
    for kind, made in events.EVENT_MAKERS.items():
        sent = made(spark, src)
        sent = sent.withColumns({name: F.col(name).cast("timestamp") for name, type_ in sent.dtypes if type_ == "timestamp"})
        decoded = events.decode(events.encode(sent, kind), kind)
        assert decoded.filter("is_corrupt").count() == 0, kind
        back = decoded.select(*(F.col(f"event.{name}").alias(name) for name in sent.columns))
        same = sent.columns if kind != "inventory" else [c for c in sent.columns if c != "timestamp"]  # sent in milliseconds
        key = lambda row: repr(row)
        assert sorted(back.select(*same).collect(), key=key) == sorted(sent.select(*same).collect(), key=key), kind
        missing = decoded.filter(f"key <> cast(event.{TOPIC_KEYS[kind]} as string)").count()
        assert missing == 0, kind


def test_resumed_stream_reads_only_what_is_new(spark, tmp_path):
    landing, home = str(tmp_path / "in"), str(tmp_path / "home")
    for value in ("1", "2"):
        runner.land(messages(spark, value), landing)
        table = runner.batches_to_table(spark, runner.message_stream(spark, landing), "t", home=home)
    assert sorted((r["value"], r["batch_id"]) for r in table.collect()) == [("1", 0), ("2", 1)]
    again = runner.batches_to_table(spark, runner.message_stream(spark, landing), "t", home=home)
    assert again.count() in (0, 2)


def test_small_batches_land_everything(spark, tmp_path):
    landing = str(tmp_path / "in")
    for value in range(5):
        runner.land(messages(spark, str(value)), landing)
    stream = runner.message_stream(spark, landing, files_per_trigger=1)
    table = runner.batches_to_table(spark, stream, "t", home=str(tmp_path / "home"))
    assert sorted(r["value"] for r in table.collect()) == list("01234")
    assert table.select("batch_id").distinct().count() >= 5


def test_repeated_batch_is_written_once(spark, tmp_path):
    """A batch that runs again after a failure replaces what it wrote."""
    landing, home = str(tmp_path / "in"), str(tmp_path / "home")
    runner.land(messages(spark, "1"), landing)
    tries = []

    def fail_once(batch):
        result = batch.withColumn("n", F.lit(1))
        if not tries:
            tries.append(1)
            result.withColumn("batch_id", F.lit(0)).write.partitionBy("batch_id").parquet(f"{home}/out")
            raise RuntimeError("lost")
        return result

    for _ in range(2):
        try:
            table = runner.batches_to_table(spark, runner.message_stream(spark, landing), "t", transform=fail_once, home=home)
        except Exception:
            pass
    assert [r["value"] for r in table.collect()] == ["1"]


def test_newest_state_wins(spark):
    table = spark.createDataFrame([(1, 5, 0), (1, 7, 2), (2, 3, 1)], "k int, v int, batch_id int")
    assert sorted(map(tuple, runner.latest(table, ["k"]).collect())) == [(1, 7), (2, 3)]


def test_events_may_be_a_folder(spark, src, tmp_path):
    staging.raw(spark, src, "events").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    counts = runner.append_to_table(spark, runner.event_stream(spark, str(tmp_path)).select("event_id"), "t")
    assert counts.count() == staging.raw(spark, src, "events").count()


def test_empty_stream(spark, src, tmp_path):
    staging.raw(spark, src, "events").filter("false").write.parquet(str(tmp_path / "events.parquet"))
    stream = runner.event_stream(spark, str(tmp_path))
    assert runner.batches_to_table(spark, stream.select("event_id"), "t").count() == 0


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_open_tails_come_from_the_state_alone(spark, src):
    """The events are scanned by the stream only; what the result reads is its table and its checkpoint."""
    for build in (queries.stream_sessions, queries.stream_click_to_purchase):
        result = build(spark, src)
        assert "events.parque" not in result._jdf.queryExecution().toString()
        assert False in {r["is_open"] for r in result.select("is_open").distinct().collect()}


def test_click_state_holds_minutes_not_events(spark, tmp_path):
    """A hot user's purchases are summed before the join: its state has a row per minute."""
    rows = [(i, datetime.datetime(2024, 1, 1, 10, i % 3, i % 60), 1, kind, 2.0, "{}") for i in range(300) for kind in ("click", "purchase")]
    rows.append((9999, datetime.datetime(2024, 1, 1, 10, 40), 2, "purchase", 1.0, "{}"))
    rows.append((9998, datetime.datetime(2024, 1, 1, 10, 40), 2, "click", 1.0, "{}"))
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    df.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    held = {}
    original = runner.Run.state
    try:
        runner.Run.state = lambda self, operator, **o: held.setdefault((operator, str(o)), original(self, operator, **o))
        result = {(r["user_id"], r["minute"]): r for r in queries.stream_click_to_purchase(spark, str(tmp_path)).collect()}
    finally:
        runner.Run.state = original
    assert max(state.count() for state in held.values()) <= 3
    assert sorted(result) == [(1, f"2024-01-01 10:0{m}:00") for m in range(3)] + [(2, "2024-01-01 10:40:00")]
    assert [(r["purchases"], r["is_open"]) for _, r in sorted(result.items())] == [(100, False)] * 3 + [(1, True)]


def test_engine_counts_the_late_events_of_the_side_table(spark, src):
    run, counted, refused = queries.late_events(spark, src)
    late = refused.count()
    assert late > 0 and run.dropped == late
    assert {r["event_type"] for r in refused.select("event_type").distinct().collect()} == {"purchase"}
    assert late + counted.count() == staging.raw(spark, src, "events").count()
    assert refused.join(counted, "event_id", "left_semi").count() == 0
    assert run.batches[0].watermark is not None


def test_state_lies_in_bounded_memory(spark, tmp_path):
    """Many keys: the state store is RocksDB, and takes no more memory than the setting allows."""
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
    spark.range(200_000).selectExpr("id", "timestamp '2024-01-01 00:00:00' as ts", "repeat('x', 200) as pad").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint, ts timestamp, pad string").parquet(str(tmp_path / "in"))
    grouped = stream.withWatermark("ts", "1 hour").groupBy("id", F.window("ts", "1 hour")).agg(F.max("pad").alias("pad"))
    run = runner.run_batches(spark, grouped.select("id"), "many", mode="update", home=str(tmp_path / "home"))
    newest = run.batches[-1]
    assert newest.state_rows == 200_000
    assert 0 < newest.state_bytes <= session.STATE_MEMORY_MB << 20
    assert run.state(run.operators("stateStoreSave")[0]).count() == 200_000


def test_own_state_store_is_kept(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "com.example.OwnProvider")
    assert session.tune(own).conf.get("spark.sql.streaming.stateStore.providerClass") == "com.example.OwnProvider"


def test_running_stream_commits_and_resumes(spark, tmp_path):
    landing, home = str(tmp_path / "in"), str(tmp_path / "home")
    for value in ("1", "2"):
        runner.land(messages(spark, value), landing)
        running = runner.follow(runner.message_stream(spark, landing), home)
        try:
            running.processAllAvailable()
        finally:
            running.stop()
    assert sorted(r["value"] for r in spark.read.parquet(f"{home}/out").collect()) == ["1", "2"]


def test_nothing_arrived(spark, src, tmp_path):
    staging.raw(spark, src, "events").filter("false").write.parquet(str(tmp_path / "events.parquet"))
    for build in (queries.stream_sessions, queries.stream_click_to_purchase, queries.stream_late_data):
        assert build(spark, str(tmp_path)).count() == 0


def test_bad_rows_hold_up_no_others(spark, tmp_path):
    rows = [(1, "ok", 1.5), (2, "x" * 200, 1.0), (3, "nan", float("nan")), (4, "inf", float("-inf")), (None, "no key", None), (6, None, 0.0)]
    df = spark.createDataFrame(rows, "id bigint, name string, rate double")
    outbox, sent = str(tmp_path / "outbox"), []
    queued, dead = events.send_batch(events.sort_out(df, "t", "id", 100), outbox, lambda m: sent.extend(m.collect()))
    assert (queued, dead) == (3, 3)
    assert sorted((r["key"], json.loads(r["value"]).get("name")) for r in sent if r["key"]) == [("1", "ok"), ("6", None)]
    assert [r["key"] for r in sent if json.loads(r["value"]).get("name") == "no key"] == [None]
    letters = {r["key"]: r["reason"] for r in events.outbox_messages(spark, outbox, dead=True).collect()}
    assert letters == {"2": "too_large", "3": "not_a_number", "4": "not_a_number"}
    # A repeated attempt replaces the outbox and sends the same.
    assert events.send_batch(events.sort_out(df, "t", "id", 100), outbox) == (3, 3)
    assert events.outbox_messages(spark, outbox, dead=False).count() == 3


def test_size_counts_bytes_of_key_and_value(spark):
    df = spark.createDataFrame([("é" * 10,)], "k string")
    size = len(json.dumps({"k": "é" * 10}, ensure_ascii=False, separators=(",", ":")).encode()) + 20
    for most, reason in ((size, None), (size - 1, "too_large")):
        assert events.sort_out(df, "t", "k", most).first()["reason"] == reason


def test_nothing_to_send(spark, tmp_path):
    df = spark.createDataFrame([], "id bigint, rate double")
    sent = []
    assert events.send_batch(events.sort_out(df, "t", "id"), str(tmp_path / "o"), sent.append) == (0, 0) and not sent


def test_one_field_of_a_message_equals_that_of_the_whole(spark):
    """Messages that are cut off, have a field of another type before or behind the amount, or repeat it."""
    good = '{"order_id":1,"order_date":"2024-01-01T00:00:00.000Z","quantity":2,"total_amount":12.34,"order_status":"x"}'
    values = [
        good, good[:-1], good.replace("12.34", '"a"'), good.replace(":2,", ':"many",'), good.replace("2024-01", "never"), "", "[]", None,
        good[:-1] + ',"total_amount":5}', good.replace('"x"', "{}"), good.replace("12.34", "null"), good + "}", good + good, "[" + good + "]",
    ]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    whole, one = (events.parse(F.col("value"), "orders", *f)["total_amount"] for f in ((), ("total_amount",)))
    rows = df.select(whole.alias("whole"), one.alias("one")).collect()
    assert [r["whole"] for r in rows] == [r["one"] for r in rows]
    assert str(rows[0]["one"]) == "12.34" and rows[1]["one"] is None


def test_topics_land_apart(spark, src, monkeypatch):
    seen = []
    keep = queries.land
    monkeypatch.setattr(queries, "land", lambda messages, path: (seen.append(path), keep(messages, path)))
    table = queries.stream_multi_topic_route(spark, src)
    assert len(set(seen)) == 9 and table.count() == 9


def test_messages_and_routed_tables_take_little_disk(spark, src, tmp_path):
    """Three fifths at most of what the default codec takes, also in small files, and the same rows."""
    sent = events.encode(events.order_events(spark, src), "orders").coalesce(1)
    landed, plain = tmp_path / "landed", tmp_path / "plain"
    runner.land(sent, str(landed))
    sent.write.parquet(str(plain))
    size = {path: sum(f.stat().st_size for f in path.glob("part-*")) for path in (landed, plain)}
    assert 0 < size[landed] < 0.6 * size[plain]
    assert spark.read.parquet(str(landed)).exceptAll(sent).count() == 0 and spark.read.parquet(str(landed)).count() == sent.count()
    run = runner.run_append(spark, runner.message_stream(spark, str(landed)).select("topic", "key"), "routed", partition_by=["topic"])
    stored = run.table.inputFiles()
    assert stored and all(name.endswith(".zstd.parquet") for name in stored) and run.table.count() == sent.count()
