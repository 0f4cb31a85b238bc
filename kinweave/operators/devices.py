"""Devices seen at login, and the anonymous events that can safely be given to their owner."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.operators import skew
from kinweave.schemas import AMPLITUDE, BRIDGE

# Fixed value: late events are taken in for the run date and this many days before it, both ends included.
LATE_DAYS = 3


def in_window(run_date: dt.date, column: str = "event_date") -> Column:
    """Constant bounds, so a table partitioned by event date is pruned to the four days."""
    return F.col(column).between(F.lit(run_date - dt.timedelta(days=LATE_DAYS)), F.lit(run_date))


def device_bridge_upsert(
    bridge: DataFrame, events: DataFrame, xref: DataFrame, run_date: dt.date, exclude_quarantined: bool = False,
) -> DataFrame:
    """Customer-device pairs after the logins of the window.

    A known pair keeps its first link and moves its last sight forward only. Old pairs and new sightings meet in
    one combining aggregation instead of a full outer join. Logins shrink to one row per (user, device) first.
    """
    logins = (
        events.filter(in_window(run_date) & F.col("amplitude_user_id").isNotNull())
        .groupBy("amplitude_user_id", "device_key")
        .agg(F.min("event_ts").alias("first_linked_ts"), F.max("event_ts").alias("last_seen_ts"))
    )
    users = xref.filter((F.col("source_system") == AMPLITUDE) & F.col("current_record_indicator"))
    if exclude_quarantined:
        users = users.filter(~F.col("is_quarantined"))
    owners = users.select(F.col("source_id").alias("amplitude_user_id"), "customer_key")
    seen = logins.join(owners, "amplitude_user_id").select(*BRIDGE.names, F.lit(False).alias("is_known"))
    known = F.col("is_known")
    return (
        bridge.select(*BRIDGE.names, F.lit(True).alias("is_known")).unionByName(seen)
        .groupBy("customer_key", "device_key")
        .agg(
            F.bool_or(known).alias("is_known"),
            F.min(F.when(known, F.col("first_linked_ts"))).alias("old_first"),
            F.min(F.when(~known, F.col("first_linked_ts"))).alias("new_first"),
            F.max("last_seen_ts").alias("last_seen_ts"),
        )
        .select(
            "customer_key", "device_key",
            F.when(F.col("is_known"), F.col("old_first")).otherwise(F.col("new_first")).alias("first_linked_ts"),
            "last_seen_ts",
        )
    )


def single_owner_devices(bridge: DataFrame) -> DataFrame:
    """Devices that were only ever linked to one customer."""
    owner = F.max("customer_key")
    return (
        bridge.groupBy("device_key").agg(owner.alias("customer_key"), F.min("customer_key").alias("other_key"))
        .filter(F.col("customer_key") == F.col("other_key")).drop("other_key")
    )


def stitched_window(events: DataFrame, bridge: DataFrame, run_date: dt.date) -> DataFrame:
    """The window's events after stitching: the four date partitions a run has to rewrite.

    Only events without a customer look their device up; the rest carry a NULL lookup key.
    """
    columns = events.columns
    owners = single_owner_devices(bridge).select(
        F.col("device_key").alias("_device"), F.col("customer_key").alias("_owner"))
    anonymous = F.when(F.col("customer_key").isNull(), F.col("device_key"))
    looked_up = skew.lookup(events.filter(in_window(run_date)).withColumn("_device", anonymous), owners, "_device")
    stitched = {
        "customer_key": F.coalesce("customer_key", "_owner"),
        "is_stitched": F.when(F.col("_owner").isNotNull(), True).otherwise(F.col("is_stitched")),
    }
    return looked_up.select(*[stitched.get(c, F.col(c)).alias(c) for c in columns])


def new_stitches(events: DataFrame, bridge: DataFrame, run_date: dt.date) -> DataFrame:
    """``event_date, event_id, customer_key`` of the window's events that stitching gives to a customer: what a day adds.

    An event without an id cannot be told from others and is left out. Ids that repeat on a date get one customer.
    """
    anonymous = events.filter(in_window(run_date) & F.col("customer_key").isNull() & F.col("event_id").isNotNull()).select(
        "event_date", "event_id", "device_key")
    found = skew.lookup(anonymous, single_owner_devices(bridge), "device_key", "inner")
    return found.groupBy("event_date", "event_id").agg(F.min("customer_key").alias("customer_key"))


def with_stitches(events: DataFrame, stitches: DataFrame) -> DataFrame:
    """Events as delivered, with the customers that runs have given them since."""
    given = stitches.select(
        F.col("event_date").alias("_date"), F.col("event_id").alias("_id"), F.col("customer_key").alias("_owner"))
    same = (F.col("event_date") == F.col("_date")) & (F.col("event_id") == F.col("_id")) & F.col("customer_key").isNull()
    stitched = {
        "customer_key": F.coalesce("customer_key", "_owner"),
        "is_stitched": F.when(F.col("_owner").isNotNull(), True).otherwise(F.col("is_stitched")),
    }
    return events.join(given, same, "left").select(*[stitched.get(c, F.col(c)).alias(c) for c in events.columns])


def stitch_events(events: DataFrame, bridge: DataFrame, run_date: dt.date) -> DataFrame:
    """All events; those outside the window pass through untouched and unshuffled."""
    outside = ~F.coalesce(in_window(run_date), F.lit(False))
    return events.filter(outside).unionByName(stitched_window(events, bridge, run_date))
