"""Logins as they arrive: the streaming form of the device bridge.

A micro-batch shrinks to one row per user, device and day, written to a folder named by the batch. A batch that is run again,
after a crash say, replaces its own folder, so each login counts once; first and last sight are a minimum and a maximum, so neither the order
of files nor a file delivered twice changes them. The daily run then reads these few rows in place of the events:
:func:`kinweave.operators.devices.device_bridge_upsert` takes them as they are.

The window of late data is that of the run that reads the rows, by event date. A watermark would drop by order of arrival, and then a
replay would not equal the batch result; there is no state to bound either, as days are folded when they are read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from kinweave.operators.devices import in_window

SIGHTING = T.StructType([
    T.StructField("amplitude_user_id", T.StringType()),
    T.StructField("device_key", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("first_ts", T.TimestampNTZType()),
    T.StructField("last_ts", T.TimestampNTZType()),
])


def sightings(events: DataFrame) -> DataFrame:
    """One row per user, device and day with the first and last login; events without a user are nobody's."""
    return events.filter(F.col("amplitude_user_id").isNotNull()).groupBy("amplitude_user_id", "device_key", "event_date").agg(
        F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"))


def follow(
    spark: SparkSession, events: str, target: str, checkpoint: str, schema: T.StructType, files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Takes in all files under ``events`` that no batch has had yet, and ends; call it as often as files come.

    ``checkpoint`` remembers the files and the batch they went to; ``target`` gets a folder for each batch.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(events)

    def take(batch: DataFrame, number: int) -> None:
        sightings(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def logins(spark: SparkSession, target: str, run_date: dt.date) -> DataFrame:
    """The window's sightings as login events, two at most for each user, device and day."""
    seen = spark.read.schema(SIGHTING).parquet(target).filter(in_window(run_date))
    folded = seen.groupBy("amplitude_user_id", "device_key", "event_date").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    both = F.explode(F.array_distinct(F.array("first_ts", "last_ts"))).alias("event_ts")
    return folded.select("amplitude_user_id", "device_key", "event_date", both)
