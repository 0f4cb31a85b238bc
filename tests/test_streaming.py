"""The streaming form of the device bridge: any order of files, a repeated batch and a restart give the batch result."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from checks.fixtures import RUN_DATE
from kinweave.operators.devices import device_bridge_upsert
from kinweave.streaming.sightings import follow, logins, sightings


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_in_any_order_equals_the_batch_result(spark, case, rows, tmp_path, seed):
    events = case.fx.fx_app_event
    xref, bridge = case.run.xref, case.fx.fx_bridge_prior
    parts = [f"crc32(CAST(event_id AS STRING)) % 6 = {k}" for k in range(6)]
    random.Random(seed).shuffle(parts)
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("events", "sightings", "checkpoint"))
    for k, part in enumerate(parts):
        events.filter(part).coalesce(2).write.mode("append").parquet(source)
        if k in (2, 4, 5):
            follow(spark, source, target, checkpoint, events.schema, files_per_batch=3).awaitTermination()
    # A batch that runs again, and a file that is delivered a second time.
    again = spark.read.parquet(f"{target}/batch=1")
    again.cache().count()
    again.write.mode("overwrite").parquet(f"{target}/batch=1")
    again.unpersist()
    events.filter(parts[0]).write.mode("append").parquet(source)
    follow(spark, source, target, checkpoint, events.schema).awaitTermination()

    got = device_bridge_upsert(bridge, logins(spark, target, RUN_DATE), xref, RUN_DATE)
    assert rows(got, "customer_key", "device_key", "first_linked_ts", "last_seen_ts") == rows(
        device_bridge_upsert(bridge, events, xref, RUN_DATE), "customer_key", "device_key", "first_linked_ts", "last_seen_ts")


def test_sightings_are_few(spark):
    base = dt.datetime(2024, 1, 4)
    data = [("u", "d", base + dt.timedelta(minutes=k), (base + dt.timedelta(minutes=k)).date()) for k in range(500)] + [
        (None, "d", base, base.date()), ("u", None, base, base.date())]
    df = spark.createDataFrame(data, "amplitude_user_id string, device_key string, event_ts timestamp_ntz, event_date date")
    got = sightings(df).collect()
    assert sorted((r["device_key"] or "", r["first_ts"], r["last_ts"]) for r in got) == [
        ("", base, base), ("d", base, base + dt.timedelta(minutes=499))]
    assert sightings(df.filter(F.lit(False))).isEmpty()
