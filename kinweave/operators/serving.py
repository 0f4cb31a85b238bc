"""Consent-gated and feature views over the daily customer mart. Access is denied unless a rule grants it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators import skew

# Consent codes, the columns credit models may see, and those they must not.
PERSONALISATION = "PERSONALISATION"
GRANTED = "GRANTED"
RISK_FEATURES = (
    "customer_key", "snapshot_date", "car_version", "idr_confidence_score",
    "demo_age_band_code", "demo_residency_type_code", "demo_tenure_days",
    "onb_channel_code", "onb_kyc_status_code", "onb_id_doc_expiry_days",
    "prd_active_account_count", "prd_product_count",
    "bal_eod_aed", "bal_avg_30d_aed", "bal_min_30d_aed", "bal_trend_30d_pct",
    "txn_count_30d", "txn_inflow_sum_30d_aed", "txn_outflow_sum_30d_aed",
    "txn_has_salary_credit_30d", "txn_intl_ratio_30d_pct", "txn_recency_days",
    "eng_login_recency_days", "eng_active_days_30d",
)
NEVER_FOR_CREDIT = ("demo_nationality_code", "demo_gender_code")


def car_personalisation(
    mart: DataFrame, consent: DataFrame, as_of: dt.datetime, purpose: str = PERSONALISATION,
) -> DataFrame:
    """Latest snapshot of customers with a live consent for the purpose and no identity conflict.

    The latest date is a scalar subquery, run once and pushed to the scan. The semi join cannot multiply rows.
    """
    live = consent.filter(
        (F.col("purpose_code") == purpose) & (F.col("status_code") == GRANTED) & F.col("current_record_indicator")
        & (F.col("expires_ts").isNull() | (F.col("expires_ts") > F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")))
    ).select("customer_key")
    latest = mart.agg(F.max("snapshot_date")).scalar()
    today = mart.filter((F.col("snapshot_date") == latest) & ~F.col("idr_is_entity_conflict"))
    return skew.lookup(today, live, "customer_key", "left_semi")


def car_risk_features(mart: DataFrame) -> DataFrame:
    """Feature columns for credit and fraud models, every snapshot, no identity conflicts."""
    features = mart.filter(~F.col("idr_is_entity_conflict")).select(*RISK_FEATURES)
    leaked = set(features.columns) & set(NEVER_FOR_CREDIT)
    if leaked:
        raise ValueError(f"columns not allowed for credit decisions: {sorted(leaked)}")
    return features
