"""Device stitching, the gold copy, masking tiers and the gated views."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.fixtures import RUN_DATE
from kinweave.operators import devices, gold, masking, serving
from kinweave.schemas import BRIDGE, GOLDEN, XREF, fill_columns

EVENT = (
    "event_id long, device_key string, amplitude_user_id string, customer_key string, event_ts timestamp_ntz, "
    "event_date date, is_stitched boolean")


def event(i, device, user, day, customer=None):
    when = dt.datetime(2024, 1, day, 12)
    return (i, device, user, customer, when, when.date(), False)


def users(spark, *pairs, quarantined=()):
    rows = [{"source_system": "AMPLITUDE", "source_id": u, "customer_key": k, "is_quarantined": u in quarantined,
             "current_record_indicator": True} for u, k in pairs]
    return fill_columns(spark.createDataFrame(
        rows, "source_system string, source_id string, customer_key string, is_quarantined boolean, "
              "current_record_indicator boolean"), XREF)


def test_bridge_window_and_late_data(spark):
    bridge = spark.createDataFrame(
        [("K1", "D1", dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 9)), ("K9", "D9", None, dt.datetime(2023, 1, 1))], BRIDGE)
    events = spark.createDataFrame([
        event(1, "D1", "U1", 3), event(2, "D2", "U1", 2), event(3, "D2", "U1", 5), event(4, "D3", "U1", 1),
        event(5, "D4", None, 4), event(6, "D5", "stranger", 4), event(7, "D6", "U2", 4)], EVENT)
    xref = users(spark, ("U1", "K1"), ("U2", "K2"), quarantined=("U2",))
    got = {(r["customer_key"], r["device_key"]): (r["first_linked_ts"], r["last_seen_ts"]) for r in
           devices.device_bridge_upsert(bridge, events, xref, RUN_DATE).collect()}
    noon = dt.datetime(2024, 1, 2, 12), dt.datetime(2024, 1, 5, 12)
    assert got == {
        ("K1", "D1"): (dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 9)),  # a late event moves nothing back
        ("K9", "D9"): (None, dt.datetime(2023, 1, 1)),
        ("K1", "D2"): noon,                                                # run_date-3 counts, run_date-4 does not
        ("K2", "D6"): (dt.datetime(2024, 1, 4, 12),) * 2,
    }
    strict = devices.device_bridge_upsert(bridge, events, xref, RUN_DATE, exclude_quarantined=True)
    assert strict.filter("customer_key = 'K2'").isEmpty()


def test_stitching_touches_only_single_owner_devices(spark):
    bridge = spark.createDataFrame(
        [("K1", "one", None, None), ("K1", "two", None, None), ("K2", "two", None, None)], BRIDGE)
    events = spark.createDataFrame([
        event(1, "one", None, 4), event(2, "two", None, 4), event(3, "one", None, 1), event(4, "one", None, 6),
        event(5, "one", "U", 4, customer="K7"), event(6, None, None, 4), event(7, "free", None, 4)], EVENT)
    got = {r["event_id"]: (r["customer_key"], r["is_stitched"]) for r in
           devices.stitch_events(events, bridge, RUN_DATE).collect()}
    untouched = (None, False)
    assert got == {1: ("K1", True), 2: untouched, 3: untouched, 4: untouched, 5: ("K7", False), 6: untouched, 7: untouched}
    assert devices.stitched_window(events, bridge, RUN_DATE).count() == 5


def test_device_steps_are_idempotent(case, rows):
    again = devices.device_bridge_upsert(case.run.bridge, case.fx.fx_app_event, case.run.xref, RUN_DATE)
    assert rows(again) == rows(case.run.bridge)
    once = devices.stitch_events(case.fx.fx_app_event, case.run.bridge, RUN_DATE)
    assert rows(devices.stitch_events(once, case.run.bridge, RUN_DATE)) == rows(once)
    assert once.filter("is_stitched").count() > 0


def test_stitching_survives_a_hot_device(spark):
    """A third of the events on one device: adaptive execution splits that partition instead of queueing it."""
    events = spark.range(60000).selectExpr(
        "id AS event_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('d', id) END AS device_key",
        "CAST(NULL AS STRING) AS amplitude_user_id", "CAST(NULL AS STRING) AS customer_key",
        "TIMESTAMP_NTZ'2024-01-04 00:00:00' AS event_ts", "DATE'2024-01-04' AS event_date", "false AS is_stitched",
        "repeat(sha2(CAST(id AS STRING), 512), 3) AS event_type").repartition(16)
    bridge = spark.range(60000).selectExpr(
        "concat('K', id) AS customer_key", "CASE WHEN id = 0 THEN 'hot' ELSE concat('d', id) END AS device_key",
        "CAST(NULL AS TIMESTAMP_NTZ) AS first_linked_ts", "CAST(NULL AS TIMESTAMP_NTZ) AS last_seen_ts")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        result = devices.stitched_window(events, bridge, RUN_DATE)
        counts = {r["is_stitched"]: r["count"] for r in result.groupBy("is_stitched").count().collect()}
        collected = result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert counts == {True: 60000} and len(collected) == 60000
    assert "skew=true" in plan


def test_gold_copy(spark, case, rows):
    changed = gold.gold_changed_versions(case.fx.fx_dim_prior, RUN_DATE)
    once = gold.gold_upsert(case.fx.fx_gold_prior, changed)
    assert rows(gold.gold_upsert(once, changed)) == rows(once)
    # A corrected value within a known version is not carried; end date and flag are.
    version = case.fx.fx_gold_prior.limit(1)
    corrected = version.withColumn("full_name", F.lit("corrected")).withColumn("current_record_indicator", F.lit(False))
    row = gold.gold_upsert(version, corrected).first()
    assert row["full_name"] == version.first()["full_name"] and row["current_record_indicator"] is False


@pytest.mark.parametrize("roles, shown", [
    ((), set()),
    (("unheard of",), set()),
    ((masking.T0,), set()),
    ((masking.T1,), {"emirates_id_token"}),
    ((masking.T2,), {"full_name", "primary_email", "primary_mobile", "primary_cif_id"}),
    ((masking.T1, masking.T2), {"emirates_id_token", "full_name", "primary_email", "primary_mobile", "primary_cif_id"}),
    ((masking.T3,), {
        "emirates_id_token", "full_name", "primary_email", "primary_mobile", "primary_cif_id", "date_of_birth"}),
])
def test_masking_tiers(spark, roles, shown):
    clear = {
        "customer_key": "K", "primary_cif_id": "C1", "emirates_id_token": "EID_v1_x", "full_name": "Maya",
        "date_of_birth": dt.date(1990, 5, 6), "primary_email": "x@gmail.com", "primary_mobile": "+971501234567",
        "nationality_code": "ARE"}
    masked = {
        "primary_cif_id": None, "emirates_id_token": None, "full_name": "M****", "date_of_birth": dt.date(1990, 1, 1),
        "primary_email": "****@gmail.com", "primary_mobile": "+971*****567"}
    schema = ", ".join(f"{k} {'date' if k == 'date_of_birth' else 'string'}" for k in clear)
    df = fill_columns(spark.createDataFrame([clear], schema), GOLDEN)
    row = masking.masked_view(df, roles).first()
    for name, value in clear.items():
        assert row[name] == (value if name in shown or name not in masked else masked[name]), name
    assert masking.masked_view(df, roles).dtypes == df.dtypes


def test_policies(spark):
    assert len(masking.DEFAULT_POLICIES) == 17
    with pytest.raises(ValueError, match="unknown mask"):
        masking.resolve([masking.Policy("blur", "c", "PUBLIC", 0)], [])


def test_consent_gate(spark):
    as_of = dt.datetime(2024, 1, 6)
    mart = spark.createDataFrame(
        [(k, d, k == "conflict") for k in (
            "null", "later", "at", "withdrawn", "other", "past", "none", "conflict", "twice")
         for d in (dt.date(2024, 1, 4), dt.date(2024, 1, 5))],
        "customer_key string, snapshot_date date, idr_is_entity_conflict boolean")
    soon = dt.datetime(2024, 1, 6, 0, 0, 1)
    consent = spark.createDataFrame([
        ("null", "PERSONALISATION", "GRANTED", True, None), ("later", "PERSONALISATION", "GRANTED", True, soon),
        ("at", "PERSONALISATION", "GRANTED", True, as_of), ("withdrawn", "PERSONALISATION", "WITHDRAWN", True, None),
        ("other", "MARKETING", "GRANTED", True, None), ("past", "PERSONALISATION", "GRANTED", False, None),
        ("conflict", "PERSONALISATION", "GRANTED", True, None), ("twice", "PERSONALISATION", "GRANTED", True, None),
        ("twice", "PERSONALISATION", "GRANTED", True, soon),
    ], "customer_key string, purpose_code string, status_code string, current_record_indicator boolean, "
       "expires_ts timestamp_ntz")
    got = serving.car_personalisation(mart, consent, as_of).collect()
    assert sorted(r["customer_key"] for r in got) == ["later", "null", "twice"]
    assert {r["snapshot_date"] for r in got} == {dt.date(2024, 1, 5)}


def test_risk_features(case):
    features = serving.car_risk_features(case.fx.fx_car_daily)
    assert len(features.columns) == 24 and not set(features.columns) & set(serving.NEVER_FOR_CREDIT)


def test_policies_from_csv(spark, case, rows, tmp_path):
    """The default policies from a file mask as those in code; a file with a mistake is refused, with the mistake named."""
    from kinweave.sources.policies import masking_policies, policies_table

    policies_table(spark).coalesce(1).write.option("header", True).csv(f"{tmp_path}/policies")
    loaded = masking_policies(spark, f"{tmp_path}/policies")
    assert sorted(loaded) == sorted(masking.DEFAULT_POLICIES)
    for roles in ((), (masking.T2,)):
        assert rows(masking.masked_view(case.run.snapshot, roles, loaded)) == rows(masking.masked_view(case.run.snapshot, roles))
    for line, message in (
        ("mask_all,full_name,PUBLIC,0", "unknown mask"), ("mask_name,shoe_size,PUBLIC,0", "unknown column"),
        ("mask_name,full_name,,0", "incomplete"), ("mask_name,date_of_birth,PUBLIC,0", "does not fit"),
        ("mask_dob_year,full_name,PUBLIC,0", "does not fit"), ("show_varchar,full_name,t2_operational,20", "lacks one for PUBLIC"),
        ("mask_name,full_name,PUBLIC,0\nredact_varchar,full_name,PUBLIC,0", "two policies"),
    ):
        path = tmp_path / f"{abs(hash(line))}.csv"
        path.write_text(f"mask,column,grantee,priority\n{line}\n")
        with pytest.raises(ValueError, match=message):
            masking_policies(spark, str(path))
