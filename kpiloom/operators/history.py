"""Type 2 dimensions over time: versions joined to facts as of a date, and kept up to date by load.

A stored history has two parts. ``observed`` holds what each load has seen of an attribute, by key and
day; ``versions`` holds, per load, the whole version rows of the keys which that load touched. A key's
current versions are those of the newest load that touched it. So a load writes the keys it touched and
nothing else, in folders of its own: readers never see a half-replaced table, and a load that broke off
is run again in place. A broken load is to be run again before the next one begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.operators import dimensions
from kpiloom.sources import warehouse

LOAD = "load_number"
#: Keys that are broadcast at most.
BROADCAST_KEYS = 100_000


def as_of(facts: DataFrame, versions: DataFrame, key: str, day: str, attributes: list[str]) -> DataFrame:
    """The rows of ``facts`` with the attributes of their key's version on their ``day``.

    A row before its key's first version, or with a null key or day, has nulls there; every row stays
    and none is multiplied. Facts are reduced to the days of a key before anything is put in order:
    versions and days of a key are one sequence, in which the last version is carried forward. However
    many facts a key has, its sequence is bounded by the calendar; the facts meet it by key and day.
    """
    held = F.struct(*attributes)
    starts = versions.select(F.col(key), F.col("valid_from").alias(day), held.alias("held"), F.lit(0).alias("after"))
    days = facts.select(key, day).filter(F.col(key).isNotNull() & F.col(day).isNotNull()).distinct()
    days = days.select(key, day, F.lit(None).cast(starts.schema["held"].dataType).alias("held"), F.lit(1).alias("after"))
    so_far = Window.partitionBy(key).orderBy(day, "after").rowsBetween(Window.unboundedPreceding, 0)
    known = starts.unionByName(days).withColumn("held", F.last("held", ignorenulls=True).over(so_far))
    known = known.filter("after = 1").select(key, day, *(F.col(f"held.{name}").alias(name) for name in attributes))
    return facts.join(known, [key, day], "left")


def record(spark: SparkSession, path: str, load: int, changes: DataFrame, key: str, attribute: str) -> None:
    """Store what a load has observed (``valid_from`` and the attribute by key), and the versions of
    the keys it touches, worked out from all observations of these keys. Late ones find their place.

    A load of few keys picks their observations where they are read. Otherwise all are dealt by key and put
    in order once: one sort serves to find touched keys, to reduce a key's days and to build its versions.
    """
    observed = changes.select(key, "valid_from", attribute)
    warehouse.overwrite(observed, f"{path}/observed/{LOAD}={load}")
    everything = warehouse.read(spark, f"{path}/observed")
    touched = everything.filter(F.col(LOAD) == load).select(key).distinct()
    if touched.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        everything = everything.join(F.broadcast(touched), key, "left_semi")
    highest = F.col(attribute).desc_nulls_last()
    of_key = Window.partitionBy(key).orderBy("valid_from", highest)
    whole = of_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_day = Window.partitionBy(key, "valid_from").orderBy(highest)
    by_day = (
        everything.filter(F.col(key).isNotNull())
        .withColumn("is_touched", F.max(F.col(LOAD) == load).over(whole))
        .withColumn("place", F.row_number().over(of_day))
        .filter("is_touched and place = 1")
        .select(key, "valid_from", attribute)
    )
    warehouse.overwrite(dimensions.versions(by_day, key, attribute), f"{path}/versions/{LOAD}={load}")


def current(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The version rows of all keys, each as its newest load left them."""
    stored = warehouse.read(spark, f"{path}/versions")
    newest = stored.groupBy(key).agg(F.max(LOAD).alias(LOAD))
    return stored.join(newest, [key, LOAD], "left_semi").drop(LOAD)


def compact(spark: SparkSession, path: str, key: str, out: str) -> None:
    """Copy a history to ``out`` with one folder of each part, so that reading stops growing with the
    number of loads. Further loads go to ``out`` under numbers above 0."""
    observed = warehouse.read(spark, f"{path}/observed").drop(LOAD)
    warehouse.overwrite(observed, f"{out}/observed/{LOAD}=0")
    warehouse.overwrite(current(spark, path, key), f"{out}/versions/{LOAD}=0")
