"""Running a stream over everything that is there, and reading back what it wrote.

Each run has its own folder below the shared work folder: checkpoint, output and, where the
stream is fed from encoded messages, the landed messages. The query is stopped before its
output is read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kpiloom.session import CHECKPOINT_INTERVAL, work_dir
from kpiloom.sources.schemas import MESSAGE, RAW

BATCH = "batch_id"

#: How landed messages and tables of streams are stored. Messages repeat their field names in every row: with
#: this codec, over pages of 4 MB, they take about a third of what the default takes (a bit over half in small files).
STORED = {"compression": "zstd", "parquet.page.size": str(4 << 20)}


def event_stream(spark: SparkSession, src: str, files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a stream. The one-letter pattern lets the path name a file or a folder."""
    reader = spark.readStream.schema(RAW["events"])
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return (
        reader.parquet(f"{src}/events.parque[t]")
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )


def land(messages: DataFrame, path: str) -> None:
    """Put messages where a stream can pick them up (in place of a broker)."""
    messages.write.mode("append").options(**STORED).parquet(path)


def message_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


@dataclass
class Batch:
    """What the engine reports of one micro-batch. ``watermark`` is the one that the batch worked with
    (none before the first), ``dropped`` the rows that its stateful operators refused as late."""

    batch_id: int
    rows: int
    watermark: str | None
    dropped: int
    state_rows: int
    state_bytes: int


@dataclass
class Run:
    """A stream that has run over all that was there: its result, its folder and its batches."""

    table: DataFrame
    home: str
    batches: list[Batch]

    @property
    def dropped(self) -> int:
        return sum(b.dropped for b in self.batches)

    def operators(self, name: str) -> list[int]:
        """Ids of the stateful operators of a kind (as the engine names it), none if nothing ever ran."""
        if not self.batches:
            return []
        known = self.table.sparkSession.read.format("state-metadata").load(f"{self.home}/checkpoint")
        return sorted({r["operatorId"] for r in known.filter(F.col("operatorName") == name).select("operatorId").collect()})

    def state(self, operator: int, **options: str) -> DataFrame:
        """What an operator holds after the last batch: ``key`` and ``value``, read from the checkpoint."""
        reader = self.table.sparkSession.read.format("statestore").option("operatorId", operator)
        return reader.options(**options).load(f"{self.home}/checkpoint").select("key", "value")


def _finish(writer, checkpoint: str) -> list[Batch]:
    running = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        running.awaitTermination()
        return [_batch(p) for p in running.recentProgress]
    finally:
        running.stop()


def _batch(progress) -> Batch:
    operators = progress["stateOperators"]
    return Batch(
        progress["batchId"],
        progress["numInputRows"],
        (progress["eventTime"] or {}).get("watermark"),
        sum(o["numRowsDroppedByWatermark"] for o in operators),
        sum(o["numRowsTotal"] for o in operators),
        sum(o["memoryUsedBytes"] for o in operators),
    )


def follow(stream: DataFrame, home: str, every: str = CHECKPOINT_INTERVAL) -> StreamingQuery:
    """Start an append-mode stream into ``home`` that keeps running: a batch, and with it a commit of
    its state, at that interval. Resumed where an earlier query of the same ``home`` stopped."""
    writer = stream.writeStream.format("parquet").option("path", f"{home}/out").outputMode("append")
    return writer.option("checkpointLocation", f"{home}/checkpoint").trigger(processingTime=every).start()


def run_append(spark: SparkSession, stream: DataFrame, label: str, partition_by: list[str] | None = None) -> Run:
    """Run an append-mode stream into a file table (exactly once) and read the table."""
    home = work_dir(spark, label)
    writer = stream.writeStream.format("parquet").options(**STORED).option("path", f"{home}/out").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    batches = _finish(writer, f"{home}/checkpoint")
    return Run(spark.read.schema(stream.schema).parquet(f"{home}/out"), home, batches)


def append_to_table(spark: SparkSession, stream: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """The table of ``run_append``."""
    return run_append(spark, stream, label, partition_by).table


def run_batches(
    spark: SparkSession,
    stream: DataFrame,
    label: str,
    mode: str = "append",
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    home: str | None = None,
) -> Run:
    """Write each micro-batch to its own partition and read all of them.

    A batch that is run again after a failure replaces its own partition, so nothing is
    written twice. With a given ``home`` an earlier run is resumed.
    """
    home = home or work_dir(spark, label)
    schemas = []

    def write(batch: DataFrame, batch_id: int) -> None:
        result = transform(batch)
        schemas.append(result.schema)
        result.write.mode("overwrite").parquet(f"{home}/out/{BATCH}={batch_id}")

    batches = _finish(stream.writeStream.outputMode(mode).foreachBatch(write), f"{home}/checkpoint")
    if not schemas:
        table = transform(spark.createDataFrame([], stream.schema)).withColumn(BATCH, F.lit(0))
    else:
        table = spark.read.schema(schemas[-1].add(BATCH, "integer")).parquet(f"{home}/out")
    return Run(table, home, batches)


def batches_to_table(
    spark: SparkSession,
    stream: DataFrame,
    label: str,
    mode: str = "append",
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    home: str | None = None,
) -> DataFrame:
    """The table of ``run_batches``."""
    return run_batches(spark, stream, label, mode, transform, home).table


def run_carrying(
    spark: SparkSession,
    stream: DataFrame,
    label: str,
    step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]],
    carried: str,
    mode: str = "append",
    home: str | None = None,
) -> tuple[Run, DataFrame]:
    """Micro-batches that hand a small table on: ``step`` gets a batch and what the batch before left
    (empty at first, of the schema ``carried``), and gives the batch's result and what it leaves.

    Both are written to folders of the batch. A batch that is run again reads what the one before it
    left and replaces its own folders, so results are written once and no state runs ahead. Returned
    are the run and what its last batch left.
    """
    home = home or work_dir(spark, label)
    schemas = []

    def left_by(batch_id: int) -> DataFrame:
        if batch_id < 0:
            return spark.createDataFrame([], carried)
        return spark.read.schema(carried).parquet(f"{home}/carried/{batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        result, leaves = step(batch, left_by(batch_id - 1))
        schemas.append(result.schema)
        leaves.write.mode("overwrite").parquet(f"{home}/carried/{batch_id}")
        result.write.mode("overwrite").parquet(f"{home}/out/{BATCH}={batch_id}")

    batches = _finish(stream.writeStream.outputMode(mode).foreachBatch(write), f"{home}/checkpoint")
    if schemas:
        table = spark.read.schema(schemas[-1].add(BATCH, "integer")).parquet(f"{home}/out")
    else:
        table = step(spark.createDataFrame([], stream.schema), left_by(-1))[0].withColumn(BATCH, F.lit(0))
    return Run(table, home, batches), left_by(max((b.batch_id for b in batches), default=-1))


def latest(table: DataFrame, keys: list[str]) -> DataFrame:
    """The newest state of each key from a table of update-mode batches."""
    values = [name for name in table.columns if name not in (*keys, BATCH)]
    newest = F.max_by(F.struct(*values), BATCH).alias("newest")
    return table.groupBy(*keys).agg(newest).select(*keys, "newest.*")
