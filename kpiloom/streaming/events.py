"""Events as JSON messages: encoding, decoding and the Kafka source and sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kpiloom.sources import staging
from kpiloom.sources.schemas import EVENTS, TOPIC_KEYS, TOPICS

CORRUPT = "_corrupt_record"


def encode(df: DataFrame, kind: str) -> DataFrame:
    """Events of one kind as messages, keyed by the id of that kind."""
    return encode_batch(df, TOPICS[kind], TOPIC_KEYS[kind])


def encode_batch(df: DataFrame, topic: str, key_field: str | None = None) -> DataFrame:
    """Rows as messages of one topic; the key is optional and null where its field is null."""
    key = F.col(key_field).cast("string") if key_field else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"), F.lit(topic).alias("topic"))


#: A broker refuses larger messages unless told otherwise (bytes of key and value; a fixed value).
MAX_MESSAGE_BYTES = 1_048_576


def sort_out(df: DataFrame, topic: str, key_field: str | None = None, max_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """``encode_batch`` with a ``reason`` not to send a row, null for those that can be sent:
    ``not_a_number`` where a field holds what JSON has no number for, ``too_large`` beyond ``max_bytes``."""
    floats = [name for name, kind in df.dtypes if kind in ("double", "float")]
    odd = F.lit(False)
    for name in floats:
        odd |= F.coalesce(F.isnan(name) | (F.abs(name) == float("inf")), F.lit(False))
    key = F.col(key_field).cast("string") if key_field else F.lit(None).cast("string")
    value = F.to_json(F.struct(*df.columns))
    encoded = df.select(key.alias("key"), value.alias("value"), F.lit(topic).alias("topic"), odd.alias("odd"))
    size = F.octet_length("value") + F.coalesce(F.octet_length("key"), F.lit(0))
    return encoded.select(
        "key", "value", "topic", F.when(F.col("odd"), "not_a_number").when(size > max_bytes, "too_large").alias("reason")
    )


def send_batch(sorted_out: DataFrame, outbox: str, send: Callable[[DataFrame], None] | None = None) -> tuple[int, int]:
    """Put a batch of ``sort_out`` into ``outbox`` and send what can be sent; how many messages were
    queued, and how many went to the dead letters.

    One pass writes both parts and counts them; a row that cannot be sent holds up no other. ``send``
    (``write_topics``, say) gets the queued messages as they were written, so a repeated attempt sends
    the same ones; dead letters keep their text and reason.
    """
    seen = Observation()
    dead = F.col("reason").isNotNull()
    counted = sorted_out.withColumn("dead", dead).observe(
        seen, F.count(F.when(~F.col("dead"), 1)).alias("queued"), F.count(F.when(F.col("dead"), 1)).alias("dead")
    )
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("dead").parquet(outbox)
    found = seen.get
    if send is not None and found["queued"]:
        send(outbox_messages(sorted_out.sparkSession, outbox, dead=False).drop("reason"))
    return found["queued"], found["dead"]


def outbox_messages(spark: SparkSession, outbox: str, dead: bool) -> DataFrame:
    """The queued messages of an outbox, or its dead letters."""
    stored = spark.read.schema("key string, value string, topic string, reason string, dead boolean").parquet(outbox)
    return stored.filter(F.col("dead") == dead).drop("dead")


def parse(value: Column, kind: str, *fields: str) -> Column:
    """A message value as a struct; a value that does not parse leaves nulls and its text. With
    ``fields``, only these of the topic's schema are converted; the message is read to its end all the same."""
    of_topic = StructType.fromDDL(EVENTS[kind])
    wanted = StructType([f for f in of_topic.fields if not fields or f.name in fields]).add(CORRUPT, "string")
    return F.from_json(value, wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def decode(messages: DataFrame, kind: str) -> DataFrame:
    """Messages with their parsed ``event`` and an ``is_corrupt`` flag.

    The event goes through an array of one: no filter or projection is moved below that, so each
    message is parsed once, however often its fields are used.
    """
    parsed = messages.select("*", F.explode(F.array(parse(F.col("value"), kind))).alias("event"))
    return parsed.withColumn("is_corrupt", F.col("event").isNull() | F.col(f"event.{CORRUPT}").isNotNull())


def decoded_fields(messages: DataFrame, kind: str) -> DataFrame:
    """Key and event fields of the messages that parse; timestamps as text."""
    good = decode(messages, kind).filter(~F.col("is_corrupt")).select("key", "event.*").drop(CORRUPT)
    return good.select(
        *(
            F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name) if type_ == "timestamp" else F.col(name)
            for name, type_ in good.dtypes
        )
    )


def messages_per_key(messages: DataFrame) -> DataFrame:
    """Messages and the sum of their ledger amounts per topic and key, read from the JSON."""
    event = parse(F.col("value"), "transactions")
    return (
        messages.select("topic", "key", event.alias("event"))
        .groupBy("topic", "key")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.sum("event.debit_amount").cast("double").alias("debit"),
            F.sum("event.credit_amount").cast("double").alias("credit"),
        )
    )


# --- events made from the staging frames -----------------------------------------------------


def order_events(spark: SparkSession, src: str) -> DataFrame:
    return as_event(staging.orders(spark, src), "orders")


def delivery_events(spark: SparkSession, src: str) -> DataFrame:
    return as_event(staging.deliveries(spark, src), "deliveries")


def purchase_order_events(spark: SparkSession, src: str) -> DataFrame:
    """The purchase order behind each delivery."""
    ordered = staging.deliveries(spark, src).select(
        "po_id",
        "supplier_id",
        "product_id",
        F.col("quantity_ordered").alias("quantity"),
        "unit_cost",
        "total_cost",
        "order_date",
        F.col("promised_date").alias("expected_delivery_date"),
        F.when(F.col("delivery_status") == "in_transit", "Confirmed").otherwise("Received").alias("po_status"),
    )
    return as_event(ordered, "purchase_orders")


def inventory_events(spark: SparkSession, src: str) -> DataFrame:
    """Stock levels from the click stream: product = user, level = 3k."""
    level = F.get_json_object("props", "$.k").cast("int") * 3
    return as_event(
        staging.raw(spark, src, "events").select(
            F.col("user_id").alias("product_id"), level.alias("stock_level"), F.col("ts").alias("timestamp")
        ),
        "inventory",
    )


def customer_events(spark: SparkSession, src: str) -> DataFrame:
    return as_event(staging.customers(spark, src), "customers")


def supplier_events(spark: SparkSession, src: str) -> DataFrame:
    return as_event(staging.suppliers(spark, src), "suppliers")


def transaction_events(spark: SparkSession, src: str) -> DataFrame:
    booked = staging.transactions(spark, src)
    return as_event(booked.withColumn("net_amount", F.col("debit_amount") - F.col("credit_amount")), "transactions")


def budget_events(spark: SparkSession, src: str) -> DataFrame:
    planned = staging.budgets(spark, src)
    month = F.col("budget_date")
    return as_event(
        planned.withColumn("budget_year", F.year(month))
        .withColumn("budget_month", F.month(month))
        .withColumn("budget_quarter", F.quarter(month)),
        "budgets",
    )


def actual_events(spark: SparkSession, src: str) -> DataFrame:
    return as_event(staging.actuals(spark, src).withColumnRenamed("actual_date", "transaction_date"), "actuals")


EVENT_MAKERS = {
    "orders": order_events,
    "inventory": inventory_events,
    "customers": customer_events,
    "suppliers": supplier_events,
    "deliveries": delivery_events,
    "purchase_orders": purchase_order_events,
    "transactions": transaction_events,
    "budgets": budget_events,
    "actuals": actual_events,
}


def as_event(staged: DataFrame, kind: str) -> DataFrame:
    """The event fields the frame has, in the event's types."""
    fields = StructType.fromDDL(EVENTS[kind]).fields
    return staged.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields if f.name in staged.columns))


# --- Kafka -----------------------------------------------------------------------------------


def read_topics(spark: SparkSession, brokers: str, topics: list[str], per_trigger: int = 1_000_000) -> DataFrame:
    """A stream of messages from one or more topics, from the earliest offset."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
        .selectExpr(
            "cast(key as string) as key", "cast(value as string) as value", "topic", "partition", "offset", "timestamp"
        )
    )


def write_topics(messages: DataFrame, brokers: str) -> None:
    """Send messages to the topic each of them names; acknowledged by all replicas."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.acks", "all")
        .option("kafka.retries", 3)
        .option("kafka.compression.type", "gzip")
        .option("kafka.linger.ms", 100)
        .save()
    )
