"""Incremental loads and their audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kpiloom.sources import warehouse


def unprocessed(staged: DataFrame, processed: DataFrame, *key: str) -> DataFrame:
    """Staged rows whose key no earlier load has finished."""
    return staged.join(processed.select(*key).distinct(), list(key), "left_anti")


def unprocessed_lines(staged: DataFrame, processed: DataFrame, key: str, number: str) -> DataFrame:
    """``unprocessed`` for numbered lines of a key, with one small row per key on the other side: a bit for
    each finished line from 0 to 62. The join is by ``key`` alone, so lines that another join by ``key``
    has dealt stay where they are. Lines of other numbers, or of none, are joined by both columns."""
    small = F.coalesce(F.col(number).between(0, 62), F.lit(False))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.when(small, F.col(number)).cast("int"))
    done = processed.filter(small).groupBy(key).agg(F.bit_or(bit).alias("processed_bits"))
    marked = F.coalesce(F.col("processed_bits").bitwiseAND(bit) != 0, F.lit(False))
    few = staged.filter(small).join(done, key, "left").filter(~marked).drop("processed_bits")
    return few.unionByName(unprocessed(staged.filter(~small), processed, key, number))


def processed_keys(loaded: DataFrame, *key: str) -> DataFrame:
    """Keys to mark after a load: those that were loaded, not whatever arrived meanwhile."""
    return loaded.select(*key).distinct()


def overwrite_table(df: DataFrame, path: str) -> int:
    """Overwrite a table and return its rows, counted by the write itself."""
    seen = Observation()
    warehouse.overwrite(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def append_fact(
    fact: DataFrame, path: str, date_id: Column | str, load_id: str, derive: warehouse.Derive | None = None
) -> int:
    """Add a load to a fact, or replace it if it has run before, and return the rows written. Rows
    of other loads stay, those of the same months too. With ``derive``, ``fact`` is what the rows are
    worked out from once they are dealt to their months."""
    seen = Observation()
    warehouse.overwrite_load(fact, path, date_id, load_id, seen, derive)
    return seen.get["rows"]


def publish_table(df: DataFrame, path: str) -> int:
    """Write the next version of a table and return its rows, counted by the write itself."""
    seen = Observation()
    warehouse.publish(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def replace_months(mart: DataFrame, path: str, months: DataFrame | None = None) -> int:
    """Publish a stored mart with the months that ``mart`` holds, whole, in place of its own, and return
    the rows of these months. A mart has a row per day, so its other months are copied. ``months``
    (``month_id``) names the months of ``mart`` where they are known without working it out again."""
    spark = mart.sparkSession
    seen = Observation()
    fresh = mart.withColumn("month_id", F.floor(F.col("date_id") / 100).cast("int"))
    fresh = fresh.observe(seen, F.count(F.lit(1)).alias("rows"))
    if warehouse.exists(spark, path):
        stored = warehouse.read(spark, path)
        if months is None:
            months = mart.select(F.floor(F.col("date_id") / 100).cast("int").alias("month_id")).distinct()
        fresh = fresh.unionByName(stored.join(months, "month_id", "left_anti"))
    warehouse.publish(fresh, path)
    return seen.get["rows"]


def month_totals(fact: DataFrame, amount: str) -> DataFrame:
    return fact.groupBy("month_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(amount).cast("double").alias("amount")
    )


AUDIT = (
    "process_name string, source_system string, table_name string, record_count bigint, status string, "
    "start_time timestamp, end_time timestamp, error_message string"
)


def audit_summary(audit: DataFrame) -> DataFrame:
    """Final state of each table of a process: rows, status and number of attempts."""
    closed = F.col("status") != "IN_PROGRESS"
    return (
        audit.filter(closed)
        .groupBy("process_name", "table_name")
        .agg(
            F.max_by("record_count", "end_time").alias("record_count"),
            F.max_by("status", "end_time").alias("status"),
            F.count(F.lit(1)).alias("attempts"),
        )
    )
