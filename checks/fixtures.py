"""Test inputs derived from the driver's ``customer`` and ``events`` tables, see FIXTURES.md.

One text for both engines; only the hash function, the zone-free timestamp type and the way a few constant rows are
attached to each customer differ.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinweave.schemas import EXCEPTION, fill_columns

RUN_DATE = dt.date(2024, 1, 5)
AS_OF = dt.datetime(2024, 1, 6)
TOKEN_KEY = b"fixture-key"
TOKEN_KEY_2 = b"the key that follows it"


@dataclasses.dataclass(frozen=True)
class Dialect:
    sha256: str
    ntz: str
    attach: Callable[[str, list[tuple[str, ...]]], str]

    def ts(self, text: str) -> str:
        return f"CAST('{text}' AS {self.ntz})"

    def key(self, number: str) -> str:
        """Customer key of a core-banking customer number."""
        source = f"concat('COREBANKING|CIF', lpad(CAST({number} AS STRING), 8, '0'))"
        return f"concat('CUS_', substr({self.sha256.format(source)}, 1, 24))"


def _attach_spark(names: str, rows: list[tuple[str, ...]]) -> str:
    structs = ", ".join(f"struct({', '.join(row)})" for row in rows)
    return f"LATERAL VIEW inline(array({structs})) t AS {names}"


def _attach_duckdb(names: str, rows: list[tuple[str, ...]]) -> str:
    return f"CROSS JOIN (VALUES {', '.join('(' + ', '.join(row) + ')' for row in rows)}) t({names})"


SPARK = Dialect("sha2({}, 256)", "TIMESTAMP_NTZ", _attach_spark)
DUCKDB = Dialect("sha256({})", "TIMESTAMP", _attach_duckdb)

CIF = "concat('CIF', lpad(CAST(c_custkey AS STRING), 8, '0'))"
SF = "concat('SF', lpad(CAST(c_custkey AS STRING), 8, '0'))"
SERIAL = "lpad(CAST(c_custkey AS STRING), 9, '0')"
FIRST_NAMES = "'Amina,Omar,Layla,Yusuf,Sara,Khalid,Noor,Hassan'"
LAST_NAMES = (
    "'Rahman,Haddad,Saleh,Nasser,Farouk,Karim,Aziz,Mansour,Qasim,Darwish,Bishara,Tahan,Jaber'")


def fixture_sql(d: Dialect) -> dict[str, str]:
    """Text per fixture; ``{customer}``, ``{events}`` and ``{fx_person}`` stand for the tables read."""
    contact_kinds = d.attach("contact_type_code, source_system", [
        ("'EMAIL'", "'COREBANKING'"), ("'MOBILE'", "'COREBANKING'"), ("'ADDRESS'", "'COREBANKING'"),
        ("'EMAIL'", "'SALESFORCE'")])
    snapshots = d.attach("snapshot_date", [("DATE '2024-01-04'",), ("DATE '2024-01-05'",)])
    golden = f"""{d.key('c_custkey')} AS customer_key, {CIF} AS primary_cif_id, CAST(NULL AS STRING) AS emirates_id_token,
  CASE WHEN c_custkey % 6 = 0 THEN upper(c_name) ELSE c_name END AS full_name,
  DATE '1960-01-01' + CAST((c_custkey * 37) % 15000 AS INT) AS date_of_birth,
  concat('N', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS nationality_code,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender_code,
  CASE WHEN c_custkey % 2 = 0 OR c_custkey % 5 = 1 THEN 'ar' WHEN c_custkey % 5 = 0 THEN NULL ELSE 'en' END
    AS language_code,
  CAST(NULL AS STRING) AS marketing_channel_code, CAST(NULL AS STRING) AS primary_email,
  CAST(NULL AS STRING) AS primary_mobile, CAST(1.00 AS DECIMAL(5,4)) AS idr_confidence_score,
  FALSE AS idr_is_entity_conflict"""
    return {
        "fx_party": f"""
SELECT {CIF} AS cif_id, concat('PTY', CAST(c_custkey AS STRING)) AS party_key, c_name AS full_name,
  DATE '1960-01-01' + CAST((c_custkey * 37) % 15000 AS INT) AS date_of_birth,
  concat('N', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS nationality_code,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender_code,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 'ar' ELSE 'en' END AS language_code,
  {d.ts('2024-01-01 00:00:00')} AS source_updated_ts, c_custkey % 97 <> 0 AS current_record_indicator
FROM {{customer}}""",
        "fx_document": f"""
SELECT concat('PTY', CAST(c_custkey AS STRING)) AS party_key, 'EMIRATES_ID' AS doc_type_code,
  'ARE' AS issuing_country_code,
  CASE WHEN c_custkey % 23 = 0 THEN '784-12' ELSE concat('784-1990-', lpad(CAST(
    CASE WHEN c_custkey % 50 = 1 THEN c_custkey - 1 ELSE c_custkey END AS STRING), 7, '0'), '-1') END AS doc_number,
  DATE '2026-01-01' + CAST(c_custkey % 900 AS INT) AS expiry_date, c_custkey % 4 <> 0 AS is_verified,
  TRUE AS current_record_indicator
FROM {{customer}} WHERE c_custkey % 10 <> 9
UNION ALL
SELECT concat('PTY', CAST(c_custkey AS STRING)), 'PASSPORT', concat('N', lpad(CAST(c_nationkey AS STRING), 2, '0')),
  concat(' ab ', lpad(CAST(c_custkey AS STRING), 6, '0')), DATE '2027-01-01' + CAST(c_custkey % 700 AS INT), TRUE, TRUE
FROM {{customer}} WHERE c_custkey % 3 = 0""",
        "fx_sf_account": f"""
SELECT {SF} AS salesforce_account_id,
  CASE WHEN c_custkey % 30 = 6 THEN NULL
       WHEN c_custkey % 40 = 4 THEN concat('CIF9', lpad(CAST(c_custkey AS STRING), 7, '0'))
       ELSE concat(' CIF', lpad(CAST(c_custkey AS STRING), 8, '0'), ' ') END AS cif_external_id,
  CASE WHEN c_custkey % 12 = 2 THEN 'Other' ELSE 'Customer#' END AS first_name, {SERIAL} AS last_name,
  DATE '1960-01-01' + CAST((c_custkey * 37) % 15000 AS INT) AS birthdate, 'ar' AS preferred_language_code,
  CASE WHEN c_custkey % 3 = 0 THEN 'EMAIL' ELSE 'SMS' END AS preferred_channel_code,
  {d.ts('2024-01-02 00:00:00')} AS last_modified_ts, c_custkey % 46 = 8 AS is_deleted,
  TRUE AS current_record_indicator
FROM {{customer}} WHERE c_custkey % 2 = 0
UNION ALL
SELECT concat('SFD', CAST(c_custkey AS STRING)), {CIF}, 'Customer#', {SERIAL}, NULL, 'en', NULL,
  {d.ts('2024-01-03 00:00:00')}, FALSE, TRUE
FROM {{customer}} WHERE c_custkey % 60 = 10
UNION ALL
SELECT {SF}, concat('CIF', lpad(CAST(c_custkey + 1 AS STRING), 8, '0')), 'Customer#', {SERIAL}, NULL, 'en', NULL,
  {d.ts('2024-01-01 00:00:00')}, FALSE, TRUE
FROM {{customer}} WHERE c_custkey % 70 = 14""",
        "fx_contact_point": f"""
SELECT concat('CP', CAST(c_custkey AS STRING), '-', t.contact_type_code, '-', t.source_system) AS contact_point_key,
  {d.key('c_custkey')} AS customer_key, t.source_system,
  CASE WHEN t.source_system = 'COREBANKING' THEN {CIF} ELSE {SF} END AS source_id, t.contact_type_code,
  CASE WHEN t.contact_type_code = 'EMAIL' THEN concat(' User', CAST(c_custkey AS STRING),
         CASE WHEN t.source_system = 'SALESFORCE' AND c_custkey % 6 = 0 THEN '.b' ELSE '' END, '@Example.com ')
       WHEN t.contact_type_code = 'ADDRESS' THEN concat('Street ', CAST(c_custkey AS STRING))
       WHEN c_custkey % 5 = 0 THEN concat('050-', lpad(CAST(c_custkey AS STRING), 7, '0'))
       WHEN c_custkey % 5 = 1 THEN concat('00971 50', lpad(CAST(c_custkey AS STRING), 7, '0'))
       WHEN c_custkey % 5 = 2 THEN concat('+971 50 ', lpad(CAST(c_custkey AS STRING), 7, '0'))
       WHEN c_custkey % 5 = 3 THEN '+44 20 7946 0000' ELSE NULL END AS contact_value,
  c_custkey % 11 <> 0 AS is_primary, (c_custkey % 3 = 0) = (t.source_system = 'SALESFORCE') AS is_verified,
  c_custkey % 29 = 0 AS is_deleted,
  CASE WHEN t.source_system = 'SALESFORCE' THEN {d.ts('2024-01-02 00:00:00')} ELSE {d.ts('2024-01-01 00:00:00')} END
    AS source_effective_ts,
  TRUE AS current_record_indicator
FROM {{customer}} {contact_kinds}
WHERE t.source_system = 'COREBANKING' OR c_custkey % 2 = 0""",
        "fx_app_user": """
SELECT DISTINCT concat('APP', CAST(user_id AS STRING)) AS app_user_id,
  concat('CIF', lpad(CAST(user_id AS STRING), 8, '0')) AS cif_id, user_id % 37 <> 0 AS current_record_indicator
FROM {events}""",
        "fx_app_event": """
SELECT event_id, concat('DEV', CAST(CASE WHEN user_id % 9 = 0 THEN 0 ELSE user_id END AS STRING)) AS device_key,
  CASE WHEN event_id % 3 = 0 THEN concat('APP', CAST(user_id AS STRING)) ELSE NULL END AS amplitude_user_id,
  CAST(NULL AS STRING) AS customer_key, ts AS event_ts, CAST(ts AS DATE) AS event_date, FALSE AS is_stitched, event_type
FROM {events}""",
        "fx_consent": f"""
SELECT {d.key('c_custkey')} AS customer_key,
  CASE WHEN c_custkey % 7 = 0 THEN 'MARKETING' ELSE 'PERSONALISATION' END AS purpose_code,
  CASE WHEN c_custkey % 4 = 0 THEN 'WITHDRAWN' ELSE 'GRANTED' END AS status_code,
  c_custkey % 13 <> 0 AS current_record_indicator,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN {d.ts('2023-01-01 00:00:00')}
       ELSE {d.ts('2030-01-01 00:00:00')} END AS expires_ts
FROM {{customer}}""",
        "fx_xref_prior": f"""
SELECT 'COREBANKING' AS source_system, {CIF} AS source_id,
  CASE WHEN c_custkey % 100 = 2 THEN {d.key('c_custkey - 1')} ELSE {d.key('c_custkey')} END AS customer_key,
  CASE WHEN c_custkey % 3 = 0 THEN 'R1_PASSPORT_EXACT' ELSE 'R1_EID_EXACT' END AS match_rule_code,
  CAST(1.00 AS DECIMAL(5,4)) AS idr_confidence_score, FALSE AS is_quarantined,
  {d.ts('2024-01-01 00:00:00')} AS valid_from_ts, {d.ts('9999-12-31 00:00:00')} AS valid_to_ts,
  TRUE AS current_record_indicator, '2024-01-01' AS _batch_run_date
FROM {{customer}} WHERE c_custkey % 4 <> 3""",
        "fx_bridge_prior": f"""
SELECT {d.key('c_custkey')} AS customer_key, concat('DEV', CAST(c_custkey AS STRING)) AS device_key,
  {d.ts('2023-12-01 00:00:00')} AS first_linked_ts, {d.ts('2023-12-31 00:00:00')} AS last_seen_ts
FROM {{customer}} WHERE c_custkey % 5 = 0
UNION ALL
SELECT {d.key('c_custkey + 1')}, concat('DEV', CAST(c_custkey AS STRING)), {d.ts('2023-11-01 00:00:00')},
  {d.ts('2023-11-30 00:00:00')}
FROM {{customer}} WHERE c_custkey % 10 = 0""",
        "fx_exception_prior": f"""
SELECT 'SF_UNKNOWN_CIF' AS exception_type_code, 'SALESFORCE' AS source_system, {SF} AS source_id,
  CASE WHEN c_custkey % 80 = 4 THEN 'OPEN' ELSE 'RESOLVED' END AS status_code, DATE '2024-01-03' AS detected_date
FROM {{customer}} WHERE c_custkey % 40 = 4""",
        "fx_car_daily": f"""
SELECT {d.key('c_custkey')} AS customer_key, t.snapshot_date, 'v1' AS car_version,
  CASE WHEN c_custkey % 50 IN (0, 1) THEN CAST(0.00 AS DECIMAL(5,4)) ELSE CAST(1.00 AS DECIMAL(5,4)) END
    AS idr_confidence_score,
  c_custkey % 50 IN (0, 1) AS idr_is_entity_conflict, concat('A', CAST(c_custkey % 6 AS STRING)) AS demo_age_band_code,
  CASE WHEN c_custkey % 3 = 0 THEN 'RES' ELSE 'NONRES' END AS demo_residency_type_code,
  CAST(c_custkey % 2000 AS INT) AS demo_tenure_days,
  concat('N', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS demo_nationality_code,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS demo_gender_code,
  'APP' AS onb_channel_code, 'PASSED' AS onb_kyc_status_code, CAST(c_custkey % 900 AS INT) AS onb_id_doc_expiry_days,
  CAST(1 + c_custkey % 3 AS INT) AS prd_active_account_count, CAST(1 + c_custkey % 5 AS INT) AS prd_product_count,
  CAST(c_acctbal AS DECIMAL(18,2)) AS bal_eod_aed, CAST(c_acctbal AS DECIMAL(18,2)) AS bal_avg_30d_aed,
  CAST(c_acctbal AS DECIMAL(18,2)) AS bal_min_30d_aed, CAST(0.00 AS DECIMAL(9,4)) AS bal_trend_30d_pct,
  CAST(c_custkey % 40 AS INT) AS txn_count_30d, CAST(c_acctbal AS DECIMAL(18,2)) AS txn_inflow_sum_30d_aed,
  CAST(c_acctbal AS DECIMAL(18,2)) AS txn_outflow_sum_30d_aed, c_custkey % 2 = 0 AS txn_has_salary_credit_30d,
  CAST(0.10 AS DECIMAL(9,4)) AS txn_intl_ratio_30d_pct, CAST(c_custkey % 30 AS INT) AS txn_recency_days,
  CAST(c_custkey % 30 AS INT) AS eng_login_recency_days, CAST(c_custkey % 31 AS INT) AS eng_active_days_30d
FROM {{customer}} {snapshots}""",
        "fx_dim_prior": f"""
SELECT {golden}, {d.ts('2024-01-03 00:00:00')} AS valid_from_ts, {d.ts('9999-12-31 00:00:00')} AS valid_to_ts,
  TRUE AS current_record_indicator
FROM {{customer}} WHERE c_custkey % 3 <> 1
UNION ALL
SELECT {golden}, {d.ts('2023-12-01 00:00:00')},
  CASE WHEN c_custkey % 24 = 0 THEN {d.ts('2024-01-03 00:00:00')} ELSE {d.ts('2023-12-15 00:00:00')} END, FALSE
FROM {{customer}} WHERE c_custkey % 12 = 0""",
        "fx_gold_prior": f"""
SELECT {golden}, {d.ts('2023-12-01 00:00:00')} AS valid_from_ts, {d.ts('9999-12-31 00:00:00')} AS valid_to_ts,
  TRUE AS current_record_indicator
FROM {{customer}} WHERE c_custkey % 4 = 0
UNION ALL
SELECT {golden}, {d.ts('2024-01-03 00:00:00')}, {d.ts('9999-12-31 00:00:00')}, TRUE
FROM {{customer}} WHERE c_custkey % 5 <> 0""",
        "fx_person": f"""
SELECT {CIF} AS person_id, split_part({FIRST_NAMES}, ',', CAST(c_custkey % 8 + 1 AS INT)) AS first_name,
  split_part({LAST_NAMES}, ',', CAST((c_custkey * 7) % 13 + 1 AS INT)) AS last_name,
  DATE '1960-01-01' + CAST(c_custkey % 97 AS INT) AS date_of_birth,
  concat('user', CAST(c_custkey AS STRING), '@example.com') AS email,
  concat('+97150', lpad(CAST(c_custkey AS STRING), 7, '0')) AS mobile
FROM {{customer}}""",
        "fx_lead": f"""
SELECT concat('LEAD', CAST(c_custkey AS STRING)) AS person_id, p.first_name,
  CASE WHEN c_custkey % 6 = 1 THEN concat(p.last_name, 'i') ELSE p.last_name END AS last_name,
  CASE WHEN c_custkey % 18 = 5 THEN NULL ELSE p.date_of_birth END AS date_of_birth,
  CASE WHEN c_custkey % 9 = 2 THEN NULL WHEN c_custkey % 9 = 7 THEN concat('x', p.email) ELSE p.email END AS email,
  CASE WHEN c_custkey % 12 = 3 THEN NULL
       WHEN c_custkey % 12 = 8 THEN concat('+97150', lpad(CAST(c_custkey + 1 AS STRING), 7, '0'))
       ELSE p.mobile END AS mobile
FROM {{customer}} JOIN {{fx_person}} p ON p.person_id = {CIF}""",
    }


class Fixtures:
    """The derived tables as Spark DataFrames, built on first use."""

    _TEXT = fixture_sql(SPARK)
    _known: dict[str, dict[str, Fixtures]] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Fixtures:
        """The same (lazy) tables for every query of a session."""
        known = cls._known.setdefault(spark.sparkContext.applicationId, {})
        return known.setdefault(sf_dir, cls(spark, sf_dir))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._tables:
            text = self._TEXT.get(name)
            if text is None:
                self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                reads = {t: getattr(self, t) for t in ("customer", "events", "fx_person") if "{" + t + "}" in text}
                self._tables[name] = self.spark.sql(text, **reads)
        return self._tables[name]

    def queue(self) -> DataFrame:
        return fill_columns(self.fx_exception_prior, EXCEPTION)
