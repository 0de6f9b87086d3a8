"""Reading and writing warehouse tables.

Dimensions and marts are published in versions: a load writes a folder of its own beside the table's
earlier ones, and the folder counts from the moment its job has committed (its ``_SUCCESS`` file is
there). Readers take the newest version that counts, or a catalog view that is switched to it; a load that
is lost on the way leaves the table as it was. Old versions are deleted later, by ``expire``. Facts are the union of
their loads: each load has a folder of its own, partitioned by month. A repeated load replaces its
own folder and nothing else, so it can be run again after any failure, and rows that arrive late for
an old month join those that are there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


VERSION, COMMITTED = "version-", "_SUCCESS"


def read(spark: SparkSession, path: str) -> DataFrame:
    """A table: its newest version, or the folder itself if it is not kept in versions."""
    counted = versions(spark, path)
    return spark.read.parquet(counted[-1] if counted else path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """All version folders of a table, the oldest first, whether they count or not."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place) if status.isDirectory()]
    return sorted(f"{path}/{name}" for name in names if name.startswith(VERSION))


def versions(spark: SparkSession, path: str) -> list[str]:
    """The folders of the versions that count, the oldest first."""
    return [folder for folder in _folders(spark, path) if exists(spark, f"{folder}/{COMMITTED}")]


def publish(df: DataFrame, path: str) -> str:
    """Write a whole table as its next version, and return the version's folder. ``df`` may read the
    table's earlier versions. One load at a time writes a table."""
    spark = df.sparkSession
    taken = _folders(spark, path)
    number = int(taken[-1].rpartition(VERSION)[2]) + 1 if taken else 1
    folder = f"{path}/{VERSION}{number:010d}"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder)
    return folder


def switch(spark: SparkSession, path: str, view: str) -> None:
    """Point a catalog view at the newest version of a table. Queries that have begun go on with the
    version that they began with."""
    newest = versions(spark, path)[-1]
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{newest}`")


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest versions, and what lost loads have left before the newest. To
    be called when no query reads them any more; returns the deleted folders."""
    if keep < 1:
        raise ValueError("the newest version stays")
    kept = versions(spark, path)[-keep:]
    if not kept:
        return []
    gone = [folder for folder in _folders(spark, path) if folder < kept[-1] and folder not in kept]
    for folder in gone:
        files, place = _place(spark, folder)
        files.delete(place, True)
    return gone


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


Derive = Callable[[DataFrame], DataFrame]


def overwrite_load(
    df: DataFrame, path: str, date_id: Column | str, load_id: str, seen: Observation | None = None, derive: Derive | None = None
) -> None:
    """Write the rows of one load, in place of what an earlier run of this load has written."""
    _by_month(df, f"{path}/load_id={load_id}", date_id, seen, derive)


def _by_month(
    df: DataFrame, path: str, date_id: Column | str, seen: Observation | None, derive: Derive | None
) -> None:
    """The rebalance hint gathers each month into few files and lets AQE split a month that
    holds most of the rows over several tasks. ``derive`` works rows out behind that shuffle and
    keeps ``month_id``.
    """
    day = F.col(date_id) if isinstance(date_id, str) else date_id
    rows = df.withColumn("month_id", F.floor(day / 100).cast("int")).hint("rebalance", "month_id")
    if derive is not None:
        rows = derive(rows)
    if seen is not None:
        # Counted behind the shuffle: a map task that is run again would be counted again.
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("month_id")
        .parquet(path)
    )


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A catalog table bucketed and sorted by a join key: two tables of one bucketing join
    without a shuffle. A key that may be hot should be left to AQE's skew join instead."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; with a numeric ``column`` it is read in parallel ranges."""
    if column is None:
        return spark.read.jdbc(url=url, table=table, properties=properties)
    return spark.read.jdbc(
        url=url, table=table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=properties,
    )


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
