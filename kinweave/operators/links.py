"""Deterministic match rules: which source record belongs to which customer key, and which links conflict.

Conflicting links are kept and quarantined, never merged. Best-of-group choices and conflict tests are aggregates
(``min`` of a sort key, ``min <> max``) rather than windows, so they combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions import keys, ordering, text
from kinweave.operators import skew
from kinweave.schemas import AMPLITUDE, COREBANKING, LINK, SALESFORCE, SCORE

# Rule codes and the score of a deterministic link.
R1_EID = "R1_EID_EXACT"
R1_PASSPORT = "R1_PASSPORT_EXACT"
R2 = "R2_SF_EXTERNAL_ID"
R3 = "R3_APP_USER_ID"
CERTAIN = "1.0000"


def certain() -> Column:
    return F.lit(CERTAIN).cast(SCORE)


def primary_anchor(anchors: DataFrame, require_verified: bool = False) -> DataFrame:
    """Best token per CIF: Emirates ID before passport, verified first, latest expiry, then lowest token.

    Rows without a token drop out inside the aggregate. As a filter the test would be pushed below the join and
    have every token computed twice.
    """
    usable = "anchor_token IS NOT NULL" + (" AND is_verified" if require_verified else "")
    best = anchors.groupBy("cif_id").agg(F.expr(f"""min(CASE WHEN {usable} THEN struct(
        doc_type_code <> '{text.EMIRATES_ID}', {ordering.true_first("is_verified")},
        {ordering.latest_date_first("expiry_date")}, anchor_token, party_key, doc_type_code) END) AS best"""))
    return best.filter("best IS NOT NULL").select(
        "cif_id", "best.party_key", "best.doc_type_code", "best.anchor_token")


def conflicted_anchors(primary: DataFrame) -> DataFrame:
    """Tokens that more than one CIF has as its primary anchor. ``primary`` holds a CIF once."""
    return primary.groupBy("anchor_token").agg(F.count(F.lit(1)).alias("cif_count")).filter("cif_count > 1")


def anchor_conflicts(primary: DataFrame) -> DataFrame:
    """A row for each CIF whose token other CIFs have as well, with the number of CIFs that share it."""
    return skew.lookup(
        primary.select("cif_id", "anchor_token"), conflicted_anchors(primary), "anchor_token", "inner")


def anchored_links(primary: DataFrame, xref: DataFrame) -> DataFrame:
    """One link per CIF with an anchor, beside the anchor it rests on: the key it already has, else a minted one."""
    known = xref.filter((F.col("source_system") == COREBANKING) & F.col("current_record_indicator")).select(
        F.col("source_id").alias("cif_id"), F.col("customer_key").alias("known_key"))
    flagged = skew.lookup(primary, conflicted_anchors(primary), "anchor_token")
    return flagged.join(known, "cif_id", "left").select(
        F.lit(COREBANKING).alias("source_system"),
        F.col("cif_id").alias("source_id"),
        F.coalesce("known_key", keys.mint_key(COREBANKING, F.col("cif_id"))).alias("customer_key"),
        F.when(F.col("doc_type_code") == text.EMIRATES_ID, R1_EID).otherwise(R1_PASSPORT).alias("match_rule_code"),
        certain().alias("idr_confidence_score"),
        F.col("cif_count").isNotNull().alias("is_quarantined"),
        "cif_id", "party_key", "doc_type_code", "anchor_token",
    )


def corebanking_links(primary: DataFrame, xref: DataFrame) -> DataFrame:
    return anchored_links(primary, xref).select(*LINK.names)


def _core_keys(core_links: DataFrame) -> DataFrame:
    return core_links.select(F.col("source_id").alias("cif_id"), "customer_key", "is_quarantined")


def salesforce_links(account: DataFrame, core_links: DataFrame) -> DataFrame:
    """Live accounts whose CIF core banking knows.

    Quarantined if the account carries several CIFs, is not the latest account of its CIF, or the core link is
    quarantined.
    """
    live = account.filter(
        F.col("current_record_indicator") & ~F.col("is_deleted") & F.col("cif_external_id").isNotNull()
    ).select("salesforce_account_id", F.trim("cif_external_id").alias("cif_id"), "last_modified_ts")

    recency = f"struct({ordering.latest_ts_first('last_modified_ts')}, salesforce_account_id)"
    per_cif = live.groupBy("cif_id").agg(F.expr(f"min({recency}) AS latest"))
    several = live.groupBy("salesforce_account_id").agg(F.expr("min(cif_id) <> max(cif_id) AS has_many_cifs"))

    core = per_cif.join(_core_keys(core_links), "cif_id")
    linked = skew.lookup(live, core, "cif_id", "inner")
    judged = skew.lookup(linked, several.filter("has_many_cifs"), "salesforce_account_id")
    return judged.select(
        F.lit(SALESFORCE).alias("source_system"),
        F.col("salesforce_account_id").alias("source_id"),
        "customer_key",
        F.lit(R2).alias("match_rule_code"),
        certain().alias("idr_confidence_score"),
        F.expr(f"has_many_cifs IS NOT NULL OR latest <> {recency} OR is_quarantined").alias("is_quarantined"),
    )


def app_user_links(app_user: DataFrame, core_links: DataFrame) -> DataFrame:
    """App users mapped to a CIF; the link inherits the quarantine of the core link."""
    mapped = app_user.filter("current_record_indicator").select("app_user_id", "cif_id")
    return skew.lookup(mapped, _core_keys(core_links), "cif_id", "inner").select(
        F.lit(AMPLITUDE).alias("source_system"),
        F.col("app_user_id").alias("source_id"),
        "customer_key",
        F.lit(R3).alias("match_rule_code"),
        certain().alias("idr_confidence_score"),
        "is_quarantined",
    )


def links_today(core_links: DataFrame, sf_links: DataFrame, app_links: DataFrame) -> DataFrame:
    """All links in one schema, one per (source system, source id).

    Core links hold a CIF once already. A CRM account or app user linked to several keys keeps the lowest key and
    is quarantined.
    """
    chosen = F.min(F.struct(
        "customer_key", (~F.col("is_quarantined")).alias("clean"), "match_rule_code", "idr_confidence_score"))
    others = (
        sf_links.unionByName(app_links).groupBy("source_system", "source_id")
        .agg(chosen.alias("link"), F.max("customer_key").alias("other_key"))
        .select(
            "source_system", "source_id", "link.customer_key", "link.match_rule_code", "link.idr_confidence_score",
            (~F.col("link.clean") | (F.col("link.customer_key") != F.col("other_key"))).alias("is_quarantined"),
        )
    )
    return core_links.select(*LINK.names).unionByName(others.select(*LINK.names))


def route_leads(account: DataFrame) -> DataFrame:
    """Live CRM accounts with no CIF: leads for onboarding, never part of the golden record."""
    return account.filter(
        F.col("current_record_indicator") & ~F.col("is_deleted") & F.col("cif_external_id").isNull())
