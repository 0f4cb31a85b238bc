"""Candidates for the exception queue, and the queue's append.

A candidate has the columns ``exception_type_code, source_system, source_id, candidate_customer_keys, detail`` and
``identity``, the text its exception key is derived from.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions import keys
from kinweave.operators import skew
from kinweave.schemas import C360, COREBANKING, EXCEPTION, SALESFORCE, fill_columns

# Exception types, the attributes whose mismatch matters, and texts that enter keys or details.
MULTI_CIF = "MULTI_CIF_SAME_ANCHOR"
SF_CONFLICT = "SF_XREF_CONFLICT"
SF_UNKNOWN = "SF_UNKNOWN_CIF"
CONTACT_MISMATCH = "CONTACT_MISMATCH"
KYC_MISMATCH = "KYC_MISMATCH"
ATTRIBUTE_MISMATCH = "ATTRIBUTE_MISMATCH"
MISMATCH_ATTRIBUTES = ("full_name", "date_of_birth", "primary_email", "primary_mobile")
SF_CONFLICT_DETAIL = "salesforce link quarantined"
OPEN = "OPEN"

_KEY_ARRAY = "array<string>"


def _candidate(
    type_code: Column, system: str, source_id: Column, customer_keys: Column, detail: Column,
    identity: Column | None = None,
) -> list[Column]:
    identity = F.concat_ws("|", type_code, F.lit(system), source_id) if identity is None else identity
    return [
        type_code.alias("exception_type_code"), F.lit(system).alias("source_system"), source_id.alias("source_id"),
        customer_keys.cast(_KEY_ARRAY).alias("candidate_customer_keys"), detail.alias("detail"),
        identity.alias("identity"),
    ]


def exc_multi_cif(conflicts: DataFrame) -> DataFrame:
    """One per CIF in conflict, so that its subject stays the same when another CIF joins the anchor."""
    return conflicts.select(*_candidate(
        F.lit(MULTI_CIF), COREBANKING, F.col("cif_id"), F.lit(None),
        F.concat(F.lit("cif_count="), F.col("cif_count").cast("string"))))


def exc_sf_conflict(sf_links: DataFrame) -> DataFrame:
    return sf_links.filter("is_quarantined").select(*_candidate(
        F.lit(SF_CONFLICT), SALESFORCE, F.col("source_id"), F.array("customer_key"), F.lit(SF_CONFLICT_DETAIL)))


def exc_sf_unknown_cif(account: DataFrame, core_links: DataFrame) -> DataFrame:
    """Current accounts, deleted ones included, whose CIF has no core link."""
    named = account.filter(F.col("current_record_indicator") & F.col("cif_external_id").isNotNull()).select(
        "salesforce_account_id", "cif_external_id", F.trim("cif_external_id").alias("cif_id"))
    known = core_links.select(F.col("source_id").alias("cif_id"))
    return skew.lookup(named, known, "cif_id", "left_anti").select(*_candidate(
        F.lit(SF_UNKNOWN), SALESFORCE, F.col("salesforce_account_id"), F.lit(None),
        F.concat(F.lit("cif_external_id="), F.col("cif_external_id"))))


def exc_attribute_mismatch(survivors: DataFrame) -> DataFrame:
    """One per customer and attribute on which the sources disagree.

    ``survivors`` holds a (customer, attribute) once, see
    :func:`kinweave.operators.survivorship.surviving_rows`, so no distinct is needed.
    """
    disputed = survivors.filter(
        F.col("has_source_mismatch") & F.col("attribute_name").isin(*MISMATCH_ATTRIBUTES))
    attribute, customer = F.col("attribute_name"), F.col("customer_key")
    type_code = F.when(attribute.startswith("primary_"), CONTACT_MISMATCH).otherwise(KYC_MISMATCH)
    return disputed.select(*_candidate(
        type_code, C360, customer, F.array(customer), F.concat(F.lit("attribute="), attribute),
        identity=F.concat_ws("|", F.lit(ATTRIBUTE_MISMATCH), customer, attribute)))


def _subject() -> Column:
    """What an exception is about. Attribute mismatches of one customer share type and source id, so there the detail counts."""
    return F.concat_ws(
        "\u0001", "exception_type_code", "source_system", "source_id",
        F.when(F.col("exception_type_code").isin(CONTACT_MISMATCH, KYC_MISMATCH), F.col("detail"))).alias("subject")


def open_subjects(queue: DataFrame) -> DataFrame:
    """``subject, exception_key`` of every open row of the queue."""
    return fill_columns(queue, EXCEPTION).filter(F.col("status_code") == OPEN).select(_subject(), "exception_key")


def still_open(subjects: DataFrame, raised: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """The open subjects after a day: those there were, without the exceptions since ``resolved``, and those just raised.

    A compact table in place of the queue, of which every row ever written would have to be read.
    """
    if resolved is not None:
        subjects = skew.lookup(subjects, resolved.select("exception_key").distinct(), "exception_key", "left_anti")
    return subjects.unionByName(open_subjects(raised))


def raise_new(candidates: DataFrame, subjects: DataFrame, raised: DataFrame, run_date: dt.date) -> DataFrame:
    """Rows to append to the queue: candidates whose subject is not open, and not ``raised`` before under the same key."""
    keyed = candidates.select("*", _subject(), keys.exception_key(F.col("identity"), run_date).alias("exception_key"))
    fresh = skew.lookup(keyed, subjects.select("subject"), "subject", "left_anti")
    fresh = skew.lookup(fresh, raised.select("exception_key"), "exception_key", "left_anti")
    return fill_columns(
        fresh.withColumn("detected_date", F.lit(run_date)).withColumn("status_code", F.lit(OPEN)), EXCEPTION)


def raise_exceptions(candidates: DataFrame, queue: DataFrame, run_date: dt.date) -> DataFrame:
    """:func:`raise_new` against a whole queue. A key contains its date, so only the rows of the run date can have it."""
    raised = fill_columns(queue, EXCEPTION).filter(
        (F.col("detected_date") == F.lit(run_date)) & F.col("exception_key").isNotNull())
    return raise_new(candidates, open_subjects(queue), raised, run_date)
