"""Lists the SQL of the checks relies on, stated apart from the code under test."""

from __future__ import annotations

# Fixed values.
SNAPSHOT_COLUMNS = (
    "customer_key", "primary_cif_id", "emirates_id_token", "full_name", "date_of_birth", "nationality_code",
    "gender_code", "language_code", "marketing_channel_code", "primary_email", "primary_mobile",
    "idr_confidence_score", "idr_is_entity_conflict")
GOLDEN_COLUMNS = SNAPSHOT_COLUMNS + ("valid_from_ts", "valid_to_ts", "current_record_indicator")
TRACKED_COLUMNS = SNAPSHOT_COLUMNS[1:]
LEAD_FIELDS = ("first_name", "last_name", "date_of_birth", "email", "mobile")
RISK_COLUMNS = (
    "customer_key", "snapshot_date", "car_version", "idr_confidence_score", "demo_age_band_code",
    "demo_residency_type_code", "demo_tenure_days", "onb_channel_code", "onb_kyc_status_code", "onb_id_doc_expiry_days",
    "prd_active_account_count", "prd_product_count", "bal_eod_aed", "bal_avg_30d_aed", "bal_min_30d_aed",
    "bal_trend_30d_pct", "txn_count_30d", "txn_inflow_sum_30d_aed", "txn_outflow_sum_30d_aed",
    "txn_has_salary_credit_30d", "txn_intl_ratio_30d_pct", "txn_recency_days", "eng_login_recency_days",
    "eng_active_days_30d")
RULES = """
full_name,IDENTITY_KYC,COREBANKING,1,PRIORITY
full_name,IDENTITY_KYC,SALESFORCE,2,PRIORITY
date_of_birth,IDENTITY_KYC,COREBANKING,1,PRIORITY
date_of_birth,IDENTITY_KYC,SALESFORCE,2,PRIORITY
nationality_code,IDENTITY_KYC,COREBANKING,1,PRIORITY
gender_code,IDENTITY_KYC,COREBANKING,1,PRIORITY
language_code,PREFERENCE,SALESFORCE,1,PRIORITY
language_code,PREFERENCE,COREBANKING,2,PRIORITY
marketing_channel_code,PREFERENCE,SALESFORCE,1,PRIORITY
primary_email,CONTACT,COREBANKING,1,VERIFIED_RECENCY
primary_email,CONTACT,SALESFORCE,2,VERIFIED_RECENCY
primary_mobile,CONTACT,COREBANKING,1,VERIFIED_RECENCY
primary_mobile,CONTACT,SALESFORCE,2,VERIFIED_RECENCY
""".split()
